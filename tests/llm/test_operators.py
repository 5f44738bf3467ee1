"""Every operator against a plain version, and on awkward tables."""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicframe.llm import (
    attention_mil,
    best_fit,
    divergence_rules,
    noisy_channel,
    run_length_index,
    shared_windows,
    simhash_bk,
    super_kmers,
    token_lengths,
    token_orc,
    winnowing,
)
from topicframe.llm.encoder import Encoder, default_vocabulary

from . import brute
from .cases import PASSAGE, awkward, docs, empty, labels, odd, texts  # noqa: F401


def by_id(rows):
    return {r.doc_id: r for r in rows}


# ---------------------------------------------------------------- 1


ITEMS = [(1, PASSAGE), (2, PASSAGE), (10, "stone rivers"), (11, ""), (12, None), (13, "nothing of this is anywhere in there at all sir"), (14, texts()[2])]


@pytest.mark.parametrize("most_sent", [winnowing.MOST_SENT, 0])
def test_winnowing_finds_every_window(spark, docs, most_sent):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = brute.contaminated(awkward(), ITEMS)
    got = winnowing.contaminated(docs, items, most_sent=most_sent).withColumn("sha", F.sha2(F.array_join("items", ","), 256)).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), r.sha) for r in got} == want
    assert any(v[1] for v in want.values())


@pytest.mark.parametrize("most_sent", [winnowing.MOST_SENT, 0])
def test_winnowing_on_odd_tables(spark, odd, empty, most_sent):
    items = spark.createDataFrame([*ITEMS, (None, PASSAGE)], "item_id bigint, text string")
    assert winnowing.contaminated(odd, items, most_sent=most_sent).count() == odd.count()
    assert winnowing.contaminated(empty, items, most_sent=most_sent).count() == 0
    none = winnowing.contaminated(odd, items.limit(0), most_sent=most_sent).agg(F.sum("n_hit")).first()[0]
    assert none == 0


def _alike():
    """Two words of 1 024 letters whose polynomial sums modulo 2**64 are equal."""
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    return "".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)


@pytest.mark.parametrize("most_sent", [winnowing.MOST_SENT, 0])
def test_words_of_equal_hash_are_told_apart(spark, most_sent):
    one, other = _alike()
    tail = " two three four five six seven eight nine ten"
    items = [(1, one + tail), (2, "short " + other)]
    rows = [(1, "x " + other + tail), (2, "x " + one + tail), (3, "short " + one), (4, "short " + other)]
    got = winnowing.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), most_sent=most_sent)
    assert {r.doc_id: (r.n_hit, r["items"]) for r in got.collect()} == {1: (0, []), 2: (10, ["1"]), 3: (0, []), 4: (2, ["2"])}


def test_repeated_words_take_time_in_proportion():
    import time

    import pyarrow as pa

    items = winnowing.Items(["1", "2"], pa.array(["word " * 200, "a b c d e f g h i j k"]), 10, 5)
    table = pa.table({"text": pa.array(["word " * 100_000 + "a b c d e f g h i j"])})
    began = time.time()
    found = winnowing._judge(table, items, []).to_pylist()[0]
    assert (found["n_words"], found["n_hit"], found["items"], found["spans"]) == (100_010, 100_010, ["1", "2"], [{"first": 0, "end": 100_010}])
    assert time.time() - began < 10


def test_copies_of_a_text_go_to_several_parts(spark):
    copies = spark.createDataFrame([(i, t) for i in range(200) for t in (PASSAGE, "", None)], "doc_id bigint, text string")
    parts = winnowing._in_parts(copies).groupBy("text").agg(F.countDistinct("part").alias("n")).collect()
    assert len(parts) == 3 and all(r.n > 20 for r in parts)


# ---------------------------------------------------------------- 2 and 6


@pytest.mark.parametrize("most", [shared_windows.MOST_STRINGS, 2])
def test_super_kmers_equal_brute_force(docs, monkeypatch, most):
    monkeypatch.setattr(super_kmers, "method", lambda w, g, f=super_kmers.method: f(w, g)._replace(most=most))
    got = super_kmers.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    want = brute.repeated_words(awkward())
    assert {r[0]: tuple(r[1:]) for r in got} == want
    assert sum(v[1] for v in want.values()) > 100


@pytest.mark.parametrize("most", [shared_windows.MOST_STRINGS, 2])
def test_run_length_index_equals_brute_force(docs, monkeypatch, most):
    monkeypatch.setattr(run_length_index, "method", lambda n, g, f=run_length_index.method: f(n, g)._replace(most=most))
    got = run_length_index.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute.repeated_bytes(awkward())


@pytest.mark.parametrize("operator", [super_kmers, run_length_index])
def test_repeats_on_odd_tables(odd, empty, operator):
    rows = operator.remove_repeats(odd)
    assert rows.count() == odd.count() and rows.select("others.kept_text").first()[0] == "kept_text"
    assert rows.where("doc_id is null").agg(F.sum("n_removed")).first()[0] == 0
    assert rows.where("doc_id = 7").select("n_removed").distinct().count() == 1
    assert operator.remove_repeats(empty).count() == 0


def test_verbatim_keeps_white_space(spark):
    df = spark.createDataFrame([(1, "a  b\n\tc"), (2, None)], "doc_id bigint, text string")
    assert [r.kept_text for r in super_kmers.remove_repeats(df, verbatim=True).orderBy("doc_id").collect()] == ["a  b\n\tc", None]


@pytest.mark.parametrize("length", [5, 8, 50])
def test_run_length_index_names_the_smallest_holder(length):
    rng = np.random.default_rng(length)
    for _ in range(60):
        strings = list({bytes(rng.choice(list(b"abn"), rng.integers(length, length + 40)).tolist()) for _ in range(rng.integers(1, 25))})
        least = np.sort(rng.integers(0, 15, len(strings)))
        first: dict = {}
        for text, doc in zip(strings, least.tolist(), strict=True):
            for i in range(len(text) - length + 1):
                first.setdefault(text[i : i + length], doc)
        want = [first[t[i : i + length]] for t in strings for i in range(len(t) - length + 1)]
        assert run_length_index.smallest_holders(strings, least, length).tolist() == want


def test_index_of_a_repetitive_text_has_few_runs():
    text = np.frombuffer((b"the same line again and again, with nothing new in it at all; " * 400) + b"\xff", np.uint8)
    assert len(run_length_index.RunLengthIndex.build(text, np.array([0]), 50).start) < len(text) / 50


# ---------------------------------------------------------------- 3 and 5


@pytest.mark.parametrize(("operator", "folds", "held_out"), [(attention_mil, 5, 0), (noisy_channel, 4, 2)])
def test_classifiers_on_odd_tables(odd, empty, labels, operator, folds, held_out):
    model = operator.train(odd, labels)
    rows = operator.scored(odd, model).select("doc_id", "held_out", "score", "predicted").collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == held_out)
    assert operator.scored(empty, model).count() == 0
    untaught = operator.train(empty, labels)
    assert operator.scored(odd, untaught).count() == odd.count()


def test_a_long_text_costs_the_fit_only_itself(spark, docs, labels, monkeypatch):
    monkeypatch.setattr(attention_mil, "MOST_PASSAGES", 200)
    long = spark.createDataFrame([(-7, "words and more " * 10_000)], "doc_id bigint, text string")
    more = labels.unionByName(spark.createDataFrame([(-7, 0, 0)], labels.schema))
    want, got = attention_mil.train(docs, labels), attention_mil.train(docs.unionByName(long), more)
    assert isinstance(got, attention_mil.Model) and all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))
    assert attention_mil.fitting([3, 9, 2, 4, 1], 6).tolist() == [True, False, True, False, True]


def test_attention_finds_the_marked_passage():
    rng = np.random.default_rng(0)
    bags, y = [], np.arange(300) % 2
    for label in y:
        x = rng.normal(0, 1, (rng.integers(3, 9), attention_mil.N_FEATURES))
        if label:
            x[rng.integers(len(x)), 4] += 7
        bags.append(x)
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    x = np.concatenate(bags)
    model = attention_mil.fit(x, first, y.astype(float), steps=250)
    assert ((model.scores(x, first) > 0.5) == (y == 1)).mean() > 0.95
    a = model.attention(x, first)
    assert np.allclose(np.add.reduceat(a, first[:-1]), 1)


def held_out_f1(rows, label):
    right = sum(r.predicted and r[label] for r in rows)
    return 2 * right / (sum(r.predicted for r in rows) + sum(r[label] for r in rows))


@pytest.mark.parametrize(("operator", "label", "least"), [(attention_mil, "quality", 0.98), (noisy_channel, "toxic", 0.8)])
def test_held_out_accuracy(spark, operator, label, least):
    sf = "/root/testdata/sf0.1"
    d, y = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = operator.scored(d, operator.train(d, y)).join(y, "doc_id").where("held_out").collect()
    assert held_out_f1(rows, label) > least


def test_hidden_words_are_restored(docs, spark):
    words = spark.createDataFrame([(i, w) for i, w in enumerate(["stupid idiot moron loser trash pathetic"] * 30)], "doc_id bigint, text string")
    model = noisy_channel.language_model(words)
    for hidden, plain in {"stup1d": "stupid", "1d10t": "idiot", "m0r0n": "moron", "s t u p i d": "stupid", "tra$h": "trash", "looooser": "loser", "l.o.s.e.r": "loser", "p@th3t1c": "pathetic"}.items():
        assert noisy_channel.suspicious(f"you {hidden} there") == [hidden]
        assert noisy_channel.restore(hidden, model) == plain
    assert noisy_channel.suspicious("quite plain words!! and a *** mark") == []


# ---------------------------------------------------------------- 4


@pytest.mark.parametrize("most", [simhash_bk.MOST_IN_SHARD, 1])
def test_simhash_equals_brute_force(docs, most):
    got = simhash_bk.near_duplicates(docs, most).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == brute.near(awkward())


def test_bk_forest_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 30, dtype=np.uint64)
    near = np.concatenate([c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (20, 3), dtype=np.uint64), axis=1) for c in centre])
    fp = np.unique(np.concatenate([centre, near]))
    found = {(int(a), int(b)) for x, y in simhash_bk.Forest(np.zeros(len(fp), np.int64), fp).search(np.arange(len(fp))) for a, b in zip(x, y, strict=True)}
    want = {(i, j) for i in range(len(fp)) for j in range(len(fp)) if i != j and (int(fp[i]) ^ int(fp[j])).bit_count() <= 3}
    assert found == want and len(want) > 100


def test_chains_of_links_are_one_component(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)]
    roots = {r.u: r.root for r in simhash_bk.roots(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert roots == {**{i: 1 for i in range(2, 41)}, 101: 100}


def test_simhash_on_odd_tables(odd, empty):
    rows = simhash_bk.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (7, None)} == {7, 300}
    assert simhash_bk.near_duplicates(empty).count() == 0


# ---------------------------------------------------------------- 7, 9, 10


def tokens(rows):
    library = Encoder(default_vocabulary()).library
    return {i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}


def test_encoder_equals_the_library():
    rng = np.random.default_rng(4)
    signs = list("ab Z9\n\t '!?smdtrevléß \u0085λ中\U0001f600") + ["'ll", "'ve", "  ", "<|endoftext|>", "'s"]
    rows = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(4000)] + [None, ""]
    known = Encoder(default_vocabulary())
    counts, ids = (np.concatenate(x) for x in zip(*known.counts_and_ids(rows), strict=True))
    want = [known.library.encode(t or "", add_special_tokens=False).ids for t in rows]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_encoder_tells_pieces_of_equal_hash_apart(monkeypatch):
    from topicframe.llm import encoder as module

    rng = np.random.default_rng(8)
    one, other = _alike()
    rows = [one, other, one + other, f"{other} {one}", other * 2 + " " + one * 2, "x" + one, one]
    rows += ["".join(rng.choice(list("ab"), 1024)) for _ in range(30)]
    for fold in (lambda h: h, lambda h: h & np.uint64(15)):  # the second: hashes that collide everywhere
        monkeypatch.setattr(module, "mix", fold)
        known = Encoder(default_vocabulary())
        for _ in range(2):
            counts, ids = (np.concatenate(x) for x in zip(*known.counts_and_ids(rows), strict=True))
            want = [known.library.encode(t, add_special_tokens=False).ids for t in rows]
            assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_windows_come_from_the_hashes_of_words(spark, capsys):
    rows = spark.createDataFrame([(i, [k % 9 for k in range(n)]) for i, n in enumerate((0, 7, 8, 30))], "i int, h array<bigint>")
    got = rows.select("i", "h", divergence_rules._windows(F.col("h")).alias("w"))
    for r in got.collect():
        want = [tuple(r.h[k : k + 8]) for k in range(len(r.h) - 7)]
        assert len(r.w) == len(want) and len(set(r.w)) == len(set(zip(r.w, want))) == len(set(want))
    got.explain()
    # no element is looked up by its number
    assert "zip_with" in capsys.readouterr().out


def test_encoder_keeps_pieces_in_little_memory():
    import tracemalloc

    rng = np.random.default_rng(9)
    words = ["".join(w) for w in rng.choice(list("abcdefghij"), (60_000, 9))]
    known = Encoder(default_vocabulary())
    list(known.counts_and_ids(["a" * (1 << 18)]))
    tracemalloc.start()
    for _ in known.counts_and_ids([" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]):
        pass
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 150 * len(words), kept / len(words)


def test_encoder_takes_columns_and_forgets(monkeypatch):
    from topicframe.llm import encoder as module

    monkeypatch.setattr(module, "MOST_PIECES", 40)
    monkeypatch.setattr(module, "BLOCK_ROWS", 7)
    rows = [f"a{i % 90} b{i} it's {'é' * (i % 5)}" for i in range(200)] + [None, "", "λ", "a1"]
    known = Encoder(default_vocabulary())
    for column in (rows, pa.array(rows), pa.array(["x", *rows])[1:]):
        counts, ids = (np.concatenate(x) for x in zip(*known.counts_and_ids(column), strict=True))
        want = [known.library.encode(t or "", add_special_tokens=False).ids for t in rows]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_length_histogram(docs, empty):
    size = sorted(len(x) for x in tokens(awkward()).values())
    limits = token_lengths.limits(token_lengths.histogram(docs)).cache()
    for r in limits.collect():
        assert r.n_docs == size.count(r.length)
        assert (r.docs_from, r.tokens_from) == (sum(s >= r.length for s in size), sum(s for s in size if s >= r.length))
        assert (r.docs_to, r.tokens_to) == (sum(s <= r.length for s in size), sum(s for s in size if s <= r.length))
        assert r.truncated_tokens == sum(min(s, r.length) for s in size)
    assert {r.context: r.kept_tokens for r in token_lengths.truncated_totals(limits, [1, 77, 10**6]).collect()} == {c: sum(min(s, c) for s in size) for c in (1, 77, 10**6)}
    assert {r.share: r.length for r in token_lengths.quantiles(limits, [0.25, 0.5, 1.0]).collect()} == {q: size[int(np.ceil(q * len(size))) - 1] for q in (0.25, 0.5, 1.0)}
    assert token_lengths.limits(token_lengths.histogram(empty)).count() == 0


def test_length_limits_that_no_document_has(odd, empty):
    size = sorted(len(x) for x in tokens([(k, r.text) for k, r in enumerate(odd.select("text").collect())]).values())
    rows = {r.length: r for r in token_lengths.limits(token_lengths.histogram(odd), [77, 10**6], [0.25, 0.5, 1.0]).collect()}
    assert (rows[77].n_docs, rows[77].docs_from, rows[77].truncated_tokens) == (size.count(77), sum(s >= 77 for s in size), sum(min(s, 77) for s in size))
    assert (rows[10**6].docs_from, rows[10**6].truncated_tokens) == (0, sum(size))
    assert sorted((q, n) for n, r in rows.items() for q in r.quantile_of) == [(q, size[int(np.ceil(q * len(size))) - 1]) for q in (0.25, 0.5, 1.0)]
    assert token_lengths.limits(token_lengths.histogram(empty), [5], [0.5]).select("docs_to", "quantile_of").collect() == [(0, [])]


def test_token_files_hold_every_id(spark, odd, docs, empty, tmp_path):
    token_orc.write(docs, str(tmp_path / "t"))
    at = 0
    got = by_id(token_orc.digests(spark, str(tmp_path / "t")).collect())
    for i, ids in sorted(tokens(awkward()).items()):
        ids = [*ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4")))
        at += len(ids)
    # a writer that cuts a range into several files
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 2)
    try:
        token_orc.write(docs, str(tmp_path / "cut"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert {r.doc_id: tuple(r) for r in token_orc.digests(spark, str(tmp_path / "cut")).collect()} == {i: tuple(r) for i, r in got.items()}
    token_orc.write(odd, str(tmp_path / "o"))
    rows = token_orc.digests(spark, str(tmp_path / "o")).collect()
    assert len(rows) == odd.count() and sorted(r.start for r in rows)[0] == 0 and len({r.start for r in rows}) == len(rows)
    token_orc.write(empty, str(tmp_path / "e"))
    assert token_orc.digests(spark, str(tmp_path / "e")).count() == 0


def test_token_files_have_indexes(spark, docs, tmp_path):
    token_orc.write(docs, str(tmp_path / "t"))
    plan = token_orc.read(spark, str(tmp_path / "t")).where("doc_id = 103")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,103)" in plan
    raw = b"".join(f.read_bytes() for f in (tmp_path / "t").glob("part-*.orc"))
    assert raw.startswith(b"ORC") and token_orc.read(spark, str(tmp_path / "t")).where("doc_id = 103").count() == 1


@pytest.mark.parametrize("sizes", [(16, 64, 256), (100,)])
def test_packing_is_whole_and_fits(odd, empty, sizes):
    pieces = best_fit.lengths(odd).cache()
    rows = best_fit.packed(pieces, sizes, group=10).collect()
    assert sum(r.length for r in rows) == pieces.agg(F.sum("length")).first()[0]
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    whole = {}
    for own in bins.values():
        own.sort(key=lambda r: (r.bin_offset, r.length))
        used = sum(r.length for r in own)
        ends = [0, *np.cumsum([r.length for r in own]).tolist()]
        assert [r.bin_offset for r in own] == ends[:-1] or own[0].bin_id.startswith("full")
        if not own[0].bin_id.startswith("full"):
            assert own[0].capacity == min(s for s in sizes if s >= used)
        for r in own:
            whole.setdefault(r.doc_id, []).append(r.part)
    assert len(whole) == odd.select("doc_id").distinct().count()
    assert best_fit.packed(best_fit.lengths(empty)).count() == 0


def test_no_full_bin_is_shared(spark):
    rows = [(7, 1, 250), (7, 1, 250), (7, 1, 250), (None, 2, 100), (None, 2, 100), (-1, 2, 100), (8, 3, 99)]
    placed = best_fit.packed(spark.createDataFrame(rows, "doc_id bigint, tie bigint, length bigint"), (100,))
    used = placed.groupBy("bin_id").agg(F.sum("length").alias("used"), F.max("capacity").alias("room")).collect()
    assert all(r.used <= r.room for r in used) and sum(r.used for r in used) == sum(r[2] for r in rows)
    assert sum(r.bin_id.startswith("full") for r in used) == 9


def test_best_fit_fills_bins():
    rng = np.random.default_rng(3)
    sizes = np.sort(np.minimum(rng.lognormal(6, 1, 5000).astype(np.int64), 8192))[::-1]
    bins, offset, capacity = best_fit.pack(sizes, best_fit.SIZES)
    used = np.bincount(bins, sizes)
    assert (used <= capacity).all() and sizes.sum() / capacity.sum() > 0.99


# ---------------------------------------------------------------- 8


def test_rule_counts_equal_brute_force(docs):
    rows = divergence_rules.judged(docs).collect()
    for r in rows:
        want = brute.rule_counts(dict(awkward())[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_rules_run_no_python(docs):
    plan = divergence_rules.judged(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_far_distributions_are_dropped(spark):
    rng = np.random.default_rng(1)
    plain = [" ".join(rng.choice("the of and to in it river stone walking slowly".split(), 200)) for _ in range(30)]
    shout = plain[0].upper().replace(" ", "!! ")
    rows = [*((i, t, "en") for i, t in enumerate(plain)), (90, shout, "en"), (91, plain[0] + " again", None)]
    kept = by_id(divergence_rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect())
    assert all(kept[i].kept for i in range(30)) and not kept[90].kept and kept[91].kept
    assert kept[90].class_distance > 0.5 > 0.2 > kept[3].class_distance


def test_texts_under_a_wrong_language_are_dropped(spark):
    """Of good texts of 100 words or more: nearly all stay, nearly none under another language."""
    root = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text", "lang").where("lang is not null")
    good = spark.read.parquet(f"{root}/labels.parquet").where("quality = 1").select("doc_id")
    turned = F.create_map(*map(F.lit, ["en", "de", "de", "fr", "fr", "es", "es", "en"]))[F.col("lang")]
    moved = docs.join(good, "doc_id").where("doc_id % 25 = 0").withColumn("lang", turned)
    strange = spark.createDataFrame([(-1, " ".join(f"qu{i}zo" for i in range(120)), "en")], "doc_id bigint, text string, lang string")
    both = docs.withColumn("wrong", F.lit(0)).unionByName(moved.withColumn("wrong", F.lit(1))).unionByName(strange.withColumn("wrong", F.lit(2)))
    rows = divergence_rules.judged(both).where("n_words >= 100 and not base_failed").select("doc_id", "kept", F.col("others.wrong").alias("wrong"))
    rows = rows.join(good, "doc_id", "left_semi").unionByName(rows.where("wrong = 2"))
    kept = {r.wrong: (r.share, r.n) for r in rows.groupBy("wrong").agg(F.avg(F.col("kept").cast("int")).alias("share"), F.count("*").alias("n")).collect()}
    assert kept[0][1] > 1000 and kept[0][0] >= 0.98
    assert kept[1][1] > 50 and kept[1][0] <= 0.1
    assert kept[2] == (0, 1)


def test_rules_on_odd_tables(odd, empty):
    assert divergence_rules.judged(odd).count() == odd.count()
    assert divergence_rules.judged(empty).count() == 0


def test_jensen_shannon_distance(spark):
    df = spark.sql("select array(0.5d, 0.5d, 0d) p, array(0.5d, 0.5d, 0d) q, array(0d, 0d, 1d) r")
    row = df.select(divergence_rules.distance(F.col("p"), F.col("q")), divergence_rules.distance(F.col("p"), F.col("r"))).first()
    assert json.loads(json.dumps([round(x, 9) for x in row])) == [0.0, 1.0]
