"""Windows of tokens that also start in a document with a smaller id, by super-k-mers.

A window is ``size`` consecutive tokens of one text. Its minimiser is the least hash of its
``gram``-token grams; equal windows have equal minimisers, and consecutive windows with the same
one form a super-k-mer, which travels as one string. Four steps, each a grouping by key:

1. Documents are dealt into parts. A part sends each distinct minimiser once, with how many
   different super-k-mers carry it there.
2. A bucket of minimisers answers which of them occur in two documents or more anywhere, and
   which are hot: carried by more than ``most`` different strings.
3. A part sends the super-k-mers of shared minimisers, each distinct string once with its least
   document id. Strings of a hot minimiser are cut into single windows, dealt by their own hash,
   so a passage found in any share of all documents reaches a bucket once from each part.
4. A bucket finds, by the caller's exact method, the least document of every window, and answers
   each part for the strings where that is smaller than the part's own.

Then each part marks the windows of its documents. What a bucket holds is bounded by the number of
parts and by ``most``, not by how often a passage occurs. The filter of steps 1 and 2 goes by hash
and can only let too much through; what is marked is decided in step 4 alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizes import dealt, parts
from .textbytes import blocks, gram_hashes, mix, sliding_min, span_hashes, text_bytes

#: different strings of one minimiser before its windows travel one by one
MOST_STRINGS = 8192
#: windows in one super-k-mer
LONGEST = 64
#: buckets of minimisers for each part of the documents; more of them hold less each
BUCKETS = 8
#: bytes of stored input for one part; larger parts send shared strings fewer times
PART_BYTES = 6 << 20
_U = np.uint64
_FLAG = 1 << 31
_EMPTY = np.zeros(0, np.int64)


class Tokens(NamedTuple):
    """A block of texts as tokens: text bytes, token (start, end), first token of each text and the end."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    edge: np.ndarray
    hashes: np.ndarray


class Runs(NamedTuple):
    """Super-k-mers: minimiser, first and last window (as token numbers), number of the text."""

    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray


class Method(NamedTuple):
    size: int
    gram: int
    #: (bytes, offsets) of texts to Tokens
    tokens: Callable[[np.ndarray, np.ndarray], Tokens]
    #: (distinct strings in ascending order of least document, those documents) to, for each
    #: string, the least document of each of its windows, all in one array
    owners: Callable[[list[bytes], np.ndarray], np.ndarray]
    #: windows in a string
    windows: Callable[[bytes], int]
    most: int = MOST_STRINGS


def runs(tokens: Tokens, size: int, gram: int) -> Runs:
    least = sliding_min(gram_hashes(tokens.hashes, gram), size - gram + 1)
    if not len(least):
        return Runs(np.zeros(0, _U), _EMPTY, _EMPTY, _EMPTY)
    new = np.ones(len(least) + 1, bool)
    np.not_equal(least[1:], least[:-1], out=new[1:-1])
    new[tokens.edge[tokens.edge <= len(least)]] = True
    head = np.flatnonzero(new)
    head, tail = head[:-1], head[1:] - 1
    text = np.searchsorted(tokens.edge, head, "right") - 1
    final = tokens.edge[1:][text] - size  # the last window of each run's text
    inside = np.flatnonzero(head <= final)
    head, tail, text = head[inside], np.minimum(tail, final)[inside], text[inside]
    # a repeated phrase keeps its minimiser for long
    pieces = (tail - head) // LONGEST + 1
    if len(pieces) and pieces.max() > 1:
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        head, tail, text = np.repeat(head, pieces) + number * LONGEST, np.repeat(tail, pieces), np.repeat(text, pieces)
        tail = np.minimum(tail, head + LONGEST - 1)
    return Runs(mix(least[head]), head, tail, text)  # least values crowd at the low end


def _bucket(h: np.ndarray, number: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(number) >> _U(32)).astype(np.int64)


def _name(h: np.ndarray, number: int) -> np.ndarray:
    """Bucket and low half of a hash: what steps 1 and 2 know of a minimiser."""
    return (_bucket(h, number) << 32) | (h & _U(0xFFFFFFFF)).astype(np.int64)


def _doc_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, whether each is not null)."""
    column = table.column("doc_id")
    there = ~np.asarray(column.is_null().combine_chunks() if isinstance(column, pa.ChunkedArray) else column.is_null())
    return column.fill_null(0).to_numpy().astype(np.int64), there


def _token_blocks(table: pa.Table, method: Method) -> Iterator[tuple[int, int, Tokens, Runs]]:
    raw, off = text_bytes(table.column("text"))
    _, there = _doc_ids(table)
    for lo, hi in blocks(off):
        tokens = method.tokens(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        found = runs(tokens, method.size, method.gram)
        known = there[lo:hi][found.text]
        yield lo, hi, tokens, found if known.all() else Runs(*(x[known] for x in found))


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) over an ascending array."""
    names, first = np.unique(bucket, return_index=True)
    yield from zip(names.tolist(), first.tolist(), np.append(first, len(bucket))[1:].tolist(), strict=True)


_ASK = "bucket int, part int, names binary, counts binary"


def _ask(method: Method, number: int):
    def run(table: pa.Table) -> pa.Table:
        ids, _ = _doc_ids(table)
        anchors, marks, docs = [], [], []
        for lo, _, tokens, found in _token_blocks(table, method):
            anchors.append(found.anchor)
            marks.append(span_hashes(tokens.raw, tokens.start[found.first], tokens.end[found.last + method.size - 1]) if len(found.first) else found.anchor)
            docs.append(ids[lo:][found.text])
        name = _name(np.concatenate(anchors), number) if anchors else _EMPTY
        if not len(name):
            return _table([], _ASK)
        mark, doc = np.concatenate(marks), np.concatenate(docs)
        order = np.lexsort((mark, name))
        name, mark, doc = name[order], mark[order], doc[order]
        new = np.ones(len(name), bool)
        new[1:] = name[1:] != name[:-1]
        head = np.flatnonzero(new)
        differs = new.copy()
        differs[1:] |= mark[1:] != mark[:-1]
        strings = np.add.reduceat(differs.astype(np.int64), head)
        several = np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head)
        count = np.minimum(strings, _FLAG - 1) | np.where(several, _FLAG, 0)
        name, count = name[head], count.astype(np.uint32)
        low, part = name.astype(np.uint32), table.column("part")[0].as_py()
        rows = [(b, part, low[i:j].tobytes(), count[i:j].tobytes()) for b, i, j in _by_bucket(name >> 32)]
        return _table(rows, _ASK)

    return run


_TYPES = {"int": pa.int32(), "binary": pa.binary(), "bigint": pa.int64()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table({name: pa.array(list(c), _TYPES[kind]) for (name, kind), c in zip(fields, columns, strict=True)})


_SHARED = "part int, bucket int, names binary, hot binary"


def _answer(method: Method):
    def run(table: pa.Table) -> pa.Table:
        names = [np.frombuffer(x, np.uint32) for x in table.column("names").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        sender = np.repeat(np.arange(len(names)), [len(x) for x in names])
        name = np.concatenate(names)
        order = np.argsort(name, kind="stable")
        new = np.ones(len(name), bool)
        new[1:] = name[order][1:] != name[order][:-1]
        head = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        several = (np.diff(np.append(head, len(name))) > 1) | (np.maximum.reduceat(counts[order], head) >= _FLAG)
        hot = np.add.reduceat(counts[order] & (_FLAG - 1), head) > method.most
        keep = several[which]
        sent, name, hot = sender[order][keep], name[order][keep], hot[which][keep]
        back = np.argsort(sent, kind="stable")
        sent, name, hot = sent[back], name[back], hot[back].astype(np.uint8)
        part, bucket = table.column("part").to_pylist(), table.column("bucket")[0].as_py()
        return _table([(part[k], bucket, name[i:j].tobytes(), hot[i:j].tobytes()) for k, i, j in _by_bucket(sent)], _SHARED)

    return run


class _Strings(NamedTuple):
    """Strings of a part that may be shared: distinct ones by bucket, and where each occurs."""

    bucket: list[int]
    text: list[bytes]
    least: np.ndarray
    string: np.ndarray  # of each occurrence
    doc: np.ndarray
    row: np.ndarray  # of the table
    first: np.ndarray  # window, counted from the text's first token
    edge: np.ndarray  # tokens of each row


def _known(found: Runs, name: np.ndarray, hot: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(runs with a shared minimiser, whether each of those is hot)."""
    if not len(name):
        return _EMPTY, np.zeros(0, bool)
    own = _name(found.anchor, number)
    at = np.minimum(np.searchsorted(name, own), len(name) - 1)
    keep = np.flatnonzero(name[at] == own)
    return keep, hot[at[keep]]


def _strings(table: pa.Table, shared: pa.Table, method: Method, number: int) -> _Strings:
    ids, _ = _doc_ids(table)
    base = np.array(shared.column("bucket").to_pylist(), np.int64) << 32
    names = [np.frombuffer(x, np.uint32).astype(np.int64) + b for x, b in zip(shared.column("names").to_pylist(), base, strict=True)]
    hots = [np.frombuffer(x, np.uint8) for x in shared.column("hot").to_pylist()]
    name = np.concatenate([*names, _EMPTY])
    hot = np.concatenate([*hots, np.zeros(0, np.uint8)]).astype(bool)
    order = np.argsort(name)
    name, hot = name[order], hot[order]
    # equal strings have the same minimiser, so the same bucket
    found_at: dict[bytes, int] = {}
    string, buckets, marks, row, first, sizes = [], [], [], [], [], np.zeros(table.num_rows, np.int64)
    for lo, hi, tokens, found in _token_blocks(table, method):
        sizes[lo:hi] = np.diff(tokens.edge)
        keep, is_hot = _known(found, name, hot, number)
        if not len(keep):
            continue
        # a hot run is cut into its windows
        pieces = np.where(is_hot, found.last[keep] - found.first[keep] + 1, 1)
        run = np.repeat(np.arange(len(keep)), pieces)
        alone = is_hot[run]
        begin = found.first[keep][run] + np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        last = np.where(alone, begin, found.last[keep][run]) + method.size - 1
        text = found.text[keep][run]
        a, b = tokens.start[begin], tokens.end[last]
        mark = span_hashes(tokens.raw, a, b)
        bucket = np.where(alone, _bucket(mark, number), _bucket(found.anchor[keep][run], number))
        data = tokens.raw.tobytes()
        string.append(np.array([found_at.setdefault(data[x:y], len(found_at)) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.int64))
        buckets.append(bucket)
        marks.append(mark)
        row.append(text + lo)
        first.append(begin - tokens.edge[:-1][text])
    # by bucket, then by hash: the same order whenever the part is read again
    names = list(found_at)
    which = np.concatenate([*string, _EMPTY])
    bucket, mark = np.empty(len(names), np.int64), np.empty(len(names), np.uint64)
    bucket[which], mark[which] = np.concatenate([*buckets, _EMPTY]), np.concatenate([*marks, np.zeros(0, _U)])
    order = np.lexsort((mark, bucket)).tolist()
    if len(names) and (np.diff(mark[order]) == 0).any():
        order.sort(key=lambda i: (bucket[i], mark[i], names[i]))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    which = rank[which]
    rows = np.concatenate([*row, _EMPTY])
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, which, ids[rows])
    return _Strings(bucket[order].tolist(), [names[i] for i in order], least, which, ids[rows], rows, np.concatenate([*first, _EMPTY]), sizes)


_SENT = "bucket int, part int, data binary, sizes binary, least binary"


def _send(method: Method, number: int):
    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        if not table.num_rows or not shared.num_rows:
            return _table([], _SENT)
        s, part = _strings(table, shared, method, number), table.column("part")[0].as_py()
        size = np.array([len(t) for t in s.text], np.int32)
        rows = [(b, part, b"".join(s.text[i:j]), size[i:j].tobytes(), s.least[i:j].tobytes()) for b, i, j in _by_bucket(np.array(s.bucket))]
        return _table(rows, _SENT)

    return run


_OWNED = "part int, bucket int, string binary, pieces binary, sizes binary, owners binary"


def _own(method: Method):
    def run(table: pa.Table) -> pa.Table:
        part, bucket = table.column("part").to_pylist(), table.column("bucket")[0].as_py()
        least = [np.frombuffer(x, np.int64) for x in table.column("least").to_pylist()]
        at: dict[bytes, int] = {}
        which: list[int] = []
        for data, sizes in zip(table.column("data").to_pylist(), table.column("sizes").to_pylist(), strict=True):
            ends = np.cumsum(np.frombuffer(sizes, np.int32)).tolist()
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                which.append(at.setdefault(data[a:b], len(at)))
        string, own = np.array(which, np.int64), np.concatenate(least)
        lowest = np.full(len(at), np.iinfo(np.int64).max)
        np.minimum.at(lowest, string, own)
        order = np.argsort(lowest, kind="stable")
        names = list(at)
        texts = [names[i] for i in order.tolist()]
        found = method.owners(texts, lowest[order])
        count = np.array([method.windows(t) for t in texts], np.int64)
        head = np.cumsum(count) - count
        # pieces of windows with the same owner
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        new[head] = True
        piece = np.flatnonzero(new)
        size, owner = np.diff(np.append(piece, len(found))), found[piece]
        first_piece = np.searchsorted(piece, np.append(head, len(found)))
        smallest = np.minimum.reduceat(owner, first_piece[:-1])
        place = np.empty(len(at), np.int64)
        place[order] = np.arange(len(at))
        rows, lo = [], 0
        for k, own in enumerate(least):
            mine = place[string[lo : lo + len(own)]]
            lo += len(own)
            told = np.flatnonzero(smallest[mine] < own)
            if not len(told):
                continue
            a, n = first_piece[mine[told]], first_piece[mine[told] + 1] - first_piece[mine[told]]
            every = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows.append((part[k], bucket, told.astype(np.int32).tobytes(), n.astype(np.int32).tobytes(), size[every].astype(np.int32).tobytes(), owner[every].tobytes()))
        return _table(rows, _OWNED)

    return run


def spans_to_remove(table: pa.Table, shared: pa.Table, owned: pa.Table, method: Method, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, last window) of the runs of windows that start in a smaller document too."""
    if not table.num_rows or not shared.num_rows:
        return _EMPTY, _EMPTY, _EMPTY
    s = _strings(table, shared, method, number)
    count = np.array([method.windows(t) for t in s.text], np.int64)
    # one piece a string unless a bucket says otherwise
    offsets = dict((b, i) for b, i, _ in _by_bucket(np.array(s.bucket, np.int64))) if s.bucket else {}
    told, told_n, told_size, told_owner = [_EMPTY], [_EMPTY], [_EMPTY], [_EMPTY]
    columns = [owned.column(c).to_pylist() for c in ("bucket", "string", "pieces", "sizes", "owners")]
    for bucket, string, pieces, sizes, owners in zip(*columns, strict=True):
        told.append(np.frombuffer(string, np.int32).astype(np.int64) + offsets[bucket])
        told_n.append(np.frombuffer(pieces, np.int32).astype(np.int64))
        told_size.append(np.frombuffer(sizes, np.int32).astype(np.int64))
        told_owner.append(np.frombuffer(owners, np.int64))
    answered, n_of = np.concatenate(told), np.concatenate(told_n)
    number_of = np.ones(len(s.text), np.int64)
    number_of[answered] = n_of
    head = np.cumsum(number_of) - number_of
    size, owner = np.empty(number_of.sum(), np.int64), np.empty(number_of.sum(), np.int64)
    size[head], owner[head] = count, s.least
    place = np.repeat(head[answered] - (np.cumsum(n_of) - n_of), n_of) + np.arange(n_of.sum())
    size[place], owner[place] = np.concatenate(told_size), np.concatenate(told_owner)
    begin = np.cumsum(size) - size
    n = number_of[s.string]
    every = np.repeat(head[s.string] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    occurrence = np.repeat(np.arange(len(s.string)), n)
    gone = owner[every] < s.doc[occurrence]
    every, occurrence = every[gone], occurrence[gone]
    start = s.first[occurrence] + begin[every] - begin[head[s.string[occurrence]]]
    return s.row[occurrence], start, start + size[every] - 1


def judged(docs: DataFrame, method: Method, finish: Callable, schema: str) -> DataFrame:
    """finish(table, row, first, last) over every part: its documents and the windows to remove."""
    in_parts = parts(docs, PART_BYTES)
    number = in_parts * BUCKETS
    rows = docs.withColumn("part", dealt(in_parts, "doc_id", "text"))
    asked = rows.groupBy("part").applyInArrow(_ask(method, number), _ASK)
    shared = asked.groupBy("bucket").applyInArrow(_answer(method), _SHARED)
    sent = rows.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_send(method, number), _SENT)
    owned = sent.groupBy("bucket").applyInArrow(_own(method), _OWNED)
    # what a part needs of the two answers, in one table
    answers = shared.select("part", "bucket", "names", "hot", *(F.lit(None).cast("binary").alias(c) for c in ("string", "pieces", "sizes", "owners")))
    answers = answers.unionByName(owned.select("part", "bucket", *(F.lit(None).cast("binary").alias(c) for c in ("names", "hot")), "string", "pieces", "sizes", "owners"))

    def end(table: pa.Table, told: pa.Table) -> pa.Table:
        is_shared = told.column("names").is_valid()
        found = spans_to_remove(table, told.filter(is_shared), told.filter(told.column("string").is_valid()), method, number)
        return finish(table, *found)

    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(end, schema)
