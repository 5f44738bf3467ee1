"""Quality rules by distribution divergence, in DataFrame functions only.

Each language has a reference: the shares of character classes and of its most common words of
any length, summed over all documents of that language. A document is compared with the reference of
its own language by Jensen-Shannon distance (the square root of the divergence, base 2, so 0 to 1)
and dropped if either is too far. For words the limit goes by length: n words drawn from the reference
itself diverge from it by about ``SAMPLING / n`` bits, so that much is allowed beside
``MOST_WORD_DIVERGENCE``. Guards: a document under ``MIN_WORDS`` words or a reference under
``MIN_REFERENCE`` words is too short for a histogram, and only the base rules judge.

The base rules count what the contract of the query names: words, characters in words, symbols,
repeated lines, and words inside 8-word windows that occur twice or more.

Defined results: a null or empty text has no words and fails the base; a null lang is a language
of its own; rows with equal doc_id are judged each for itself; an empty table gives no rows; all
other columns are carried beside the results, under a struct.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import hold

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: what is in none of the classes and no symbol; the classes are counted in the few characters left
PLAIN = r"[a-z\x20\x09-\x0D\x{80}-\x{10FFFF}]+"
#: character classes beside white space, symbols and the rest, which is mostly lower-case letters
CLASSES = {"upper": "[A-Z]+", "digit": "[0-9]+", "point": "[.,;:!?]+", "mark": "[!?]+"}
#: common words a language; with more, 100 words say less about each
COMMON = 32
_SIGNS = "".join(chr(0x41 + i) for i in range(26)) + "abcdef"
REPEAT_WINDOW = 8
MIN_WORDS = 100
MIN_REFERENCE = 1000
MOST_CLASS_DISTANCE = 0.25
#: bits beyond what a sample of the document's length explains
MOST_WORD_DIVERGENCE = 0.045
#: n times the divergence expected of n words from what they were drawn from: bins less one, over 8 ln 2
SAMPLING = round(COMMON / (8 * math.log(2)), 4)
#: common words are looked up among the few that share their slot
SLOTS = 64
#: languages whose references are sent to every task, about 5 KB each
MOST_SENT = 4_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, evaluated once a row however often body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _removed(text: Column, pattern: str) -> Column:
    """Characters that match."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _repeat_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _windows(hashes: Column) -> Column:
    """Hash of every 8-word window, from the hashes of its words by way of 2 and 4 words; empty for fewer words."""

    def joined(h: Column, width: int) -> Column:
        # two arrays side by side: no element is looked up by its number
        return F.zip_with(h, F.slice(h, F.lit(width + 1), F.size(h)), lambda x, y: F.xxhash64(x, y))

    eights = let(joined(hashes, 1), lambda h2: let(joined(h2, 2), lambda h4: joined(h4, 4)))
    return F.slice(eights, F.lit(1), F.greatest(F.size(hashes) - (REPEAT_WINDOW - 1), F.lit(0)))


def _covered(windows: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(s: Column) -> Column:
        same = lambda k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.filter(F.transform(s, lambda x, k: F.when(same(k - 1, x) | same(k + 1, x), x["i"])), lambda i: i.isNotNull()))

    def reach(p: Column) -> Column:
        step = lambda i, k: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(REPEAT_WINDOW))).cast("bigint")
        return _total(F.transform(p, step))

    some = let(ordered, lambda s: let(again(s), reach))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), some).otherwise(F.lit(0).cast("bigint"))


def _classes(text: Column, signs: Column, word_chars: Column, n_symbols: Column) -> Column:
    """Counts: white space, symbols, capitals, digits, points, question and exclamation marks, the rest."""

    def rest(counts: Column) -> Column:
        return F.concat(counts, F.array(F.greatest(F.length(text) - _total(counts), F.lit(0)).cast("bigint")))

    named = [F.length(text) - word_chars, n_symbols, *(_removed(signs, p) for p in CLASSES.values())]
    return let(F.array(*(x.cast("bigint") for x in named)), rest)


def _shares(counts: Column) -> Column:
    return let(_total(counts), lambda n: F.transform(counts, lambda x: x / F.greatest(n, F.lit(1).cast("bigint"))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two share arrays of the same length, base 2."""

    def term(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        half = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
        return (half(a) + half(b)) / 2

    total = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def counted(docs: DataFrame) -> DataFrame:
    """docs as (doc_id, lang, others) with the counts of the base rules and the words."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "lang")), F.lit(0).alias("_"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    signs = F.regexp_replace(text, PLAIN, "").alias("signs")
    base = docs.select("doc_id", lang.alias("lang"), others.alias("others"), text.alias("text"), signs, words_of(text).alias("words"))
    plain = base.select(
        "doc_id",
        "lang",
        "others",
        "text",
        "signs",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        _removed(F.col("signs"), f"[{SYMBOLS}]+").cast("bigint").alias("n_symbols"),
        _repeat_lines(F.col("text")).cast("bigint").alias("n_dup_lines"),
    )
    return plain


def _slot(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def _slotted(top: Column) -> Column:
    """For each slot its common words, and their signs behind an empty one."""
    mine = lambda k: F.filter(top, lambda x: _slot(F.xxhash64(x["word"])) == k)
    sign = lambda x: F.substring(F.lit(_SIGNS), x["place"], F.lit(1))

    def of(k: Column) -> Column:
        words, signs = F.transform(mine(k), lambda x: x["word"]), F.concat(F.array(F.lit("")), F.transform(mine(k), sign))
        return F.struct(words.alias("words"), signs.alias("signs"))

    return F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda k: of(k.cast("int")))


def references(docs: DataFrame) -> DataFrame:
    """(lang, n, class_shares, slots, word_shares) of every language."""
    rows = counted(docs)
    counts = _classes(F.col("text"), F.col("signs"), F.col("word_chars"), F.col("n_symbols"))
    sums = F.array(*(F.sum(F.col("classes")[i]) for i in range(len(CLASSES) + 3)))
    classes = rows.select("lang", "n_words", counts.alias("classes")).groupBy("lang").agg(F.sum("n_words").alias("n"), sums.alias("classes"))
    # counted in a pass of their own, since a row a word then carries the word alone
    words = rows.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    # each task passes on its first words of a language alone, so a vocabulary is in no one task
    top = words.withColumn("place", place).where(F.col("place") <= COMMON)
    top = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "word", "n"))).alias("top"))
    joined = classes.join(top, "lang", "left")
    none = F.array().cast("array<struct<place:int,word:string,n:bigint>>")
    joined = joined.withColumn("top", F.coalesce("top", none))
    counts = F.transform("top", lambda x: x["n"])
    padded = F.concat(counts, F.array_repeat(F.lit(0).cast("bigint"), F.lit(COMMON) - F.size("top")))
    return joined.select(
        "lang",
        "n",
        _shares(F.col("classes")).alias("class_shares"),
        _slotted(F.col("top")).alias("slots"),
        _shares(F.concat(padded, F.array(F.col("n") - _total(counts)))).alias("word_shares"),
    )


def judged(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, lang, others, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    class_distance, word_distance, base_failed, kept)."""
    known = hold(references(docs), "language-references")
    known = known.withColumnRenamed("n", "n_reference")
    if known.count() <= MOST_SENT:
        known = F.broadcast(known)
    # a word is hashed once, for the windows and for its slot
    rows = counted(docs).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("windows", _windows(F.col("hashes"))).withColumn("n_repeat_words", _covered(F.col("windows")))
    rows = rows.join(known, "lang", "left")
    slot = lambda h: F.get("slots", _slot(h))
    sign = lambda w, h: F.get(slot(h)["signs"], F.array_position(slot(h)["words"], w).cast("int"))
    signs = F.array_join(F.zip_with("words", "hashes", sign), "")

    def per_word(s: Column) -> Column:
        number = lambda k: F.length(s) - F.length(F.replace(s, F.substring(F.lit(_SIGNS), k, F.lit(1)), F.lit("")))
        found = F.transform(F.sequence(F.lit(1), F.lit(COMMON)), lambda k: number(k).cast("bigint"))
        return F.concat(found, F.array(F.col("n_words") - F.length(s)))

    rows = rows.withColumn("class_distance", distance(_shares(_classes(F.col("text"), F.col("signs"), F.col("word_chars"), F.col("n_symbols"))), F.col("class_shares")))
    rows = rows.withColumn("word_distance", let(let(signs, per_word), lambda c: distance(_shares(c), F.col("word_shares"))))
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    excess = F.col("word_distance") * F.col("word_distance") - SAMPLING / F.col("n_words")
    far = (F.col("class_distance") > MOST_CLASS_DISTANCE) | (excess > MOST_WORD_DIVERGENCE)
    judging = (F.col("n_words") >= min_words) & (F.col("n_reference") >= MIN_REFERENCE)
    kept = ~base_failed & ~F.coalesce(judging & far, F.lit(False))
    names = ["doc_id", "lang", "others", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance"]
    return rows.select(*names, base_failed.alias("base_failed"), kept.alias("kept"))
