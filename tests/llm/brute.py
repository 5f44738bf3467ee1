"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash


def groups(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text):
    words = spaced(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near(docs):
    fps = {i: simhash(t) for i, t in docs}
    ids = sorted(fps)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 3]
    root = groups(links, ids)
    return {i: (f"{fps[i]:016x}", root[i]) for i in ids}


def shingles(text, size=5):
    words = spaced(lower(text))
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_wide(docs):
    """{doc_id: component_id} by all pairs of whole sketches."""
    from topicframe.llm import wide_simhash as ws

    sketch = {i: [int(w) for w in ws.sketch((t or "").encode())] for i, t in docs}

    def linked(a, b):
        apart = [x ^ y for x, y in zip(sketch[a], sketch[b], strict=True)]
        bits = [x.bit_count() for x in apart]
        for band in range(ws.BANDS):
            word, slot = divmod(band, 4)
            if not apart[word] >> 16 * slot & 0xFFFF and sum(bits[(word + 1 + k) % ws.WORDS] for k in range(ws.TREE)) <= ws.RADIUS:
                return True
        return False

    ids = sorted(sketch)
    return groups([(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if linked(a, b)], ids)


def repeated_words(docs, size=13):
    """{doc_id: (n_words, n_removed, kept_sha256)}"""
    first: dict = {}
    words = {i: spaced(t) for i, t in docs}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def repeated_bytes(docs, size=50):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    first: dict = {}
    raw = {i: (t or "").encode() for i, t in docs}
    for i in sorted(raw):
        for k in range(len(raw[i]) - size + 1):
            first.setdefault(raw[i][k : k + size], i)
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first[b[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def contaminated(docs, items, size=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256)}"""
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = cut.findall(lower(text))
        for k in range(max(1, len(w) - size + 1)) if w else ():
            windows[tuple(w[k : k + size])].add(str(item))
    lengths = {len(x) for x in windows}
    out = {}
    for i, text in docs:
        w = cut.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    return out


def rule_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = spaced(text)
    lines = [x for x in text.split("\n") if spaced(x)]
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    repeat = set()
    for k in range(len(w) - 7):
        if seen[tuple(w[k : k + 8])] > 1:
            repeat.update(range(k, k + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat)


def without_repeats(docs, size=13):
    """{doc_id: kept words joined by one space}"""
    first: dict = {}
    words = {i: spaced(t) for i, t in docs}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), i)
    out = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for j in range(k, k + size)}
        out[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    return out


def hard_negatives(rows, anchors, positives=5, negatives=5, share=80):
    """Sorted (anchor, positive, rank, negative, positive score, negative score) of (vec_id, label, ints)."""
    clip = lambda x: min(max(x, -(2**63)), 2**63 - 1)
    out = []
    for a, label, q in {(i, x, tuple(v)) for i, x, v in anchors}:
        scored = sorted((-clip(sum(x * y for x, y in zip(q, v, strict=True))), i, x) for i, x, v in rows if len(v) == len(q))
        near = [(-s, i) for s, i, x in scored if x == label and i != a][:positives]
        for p, i in near:
            below = [(-s, j) for s, j, x in scored if x != label and share * p <= -100 * s <= 100 * p][:negatives]
            out += [(a, i, k, j, p, s) for k, (s, j) in enumerate(below, 1)]
    return sorted(out)


def shards(docs, number):
    """Sorted (doc_id, size, crc32, shard, slot) for docs in order."""
    import zlib

    raw = [(i, (t or "").encode()) for i, t in docs]
    total, start, used, out = sum(len(b) + 16 for _, b in raw), 0, defaultdict(int), []
    for i, b in raw:
        size = len(b) + 16
        shard = min(number - 1, (2 * start + size) * number // (2 * total))
        out.append((i, size, zlib.crc32(b), shard, used[shard]))
        used[shard] += 1
        start += size
    return out


def merkle(docs, run=16, every=5):
    """[(doc_id, leaf, subroot, root, proof, folded_root)] for (doc_id, text, lang, source, n_chars), leaves in order."""
    import zlib

    h = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()

    def leaf(i, text, lang, source, n):
        values = [None if v is None else str(v) for v in (i, source, lang, n, text)]
        return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))

    def climb(hashes):
        """(top, for each hash the runs on its way as (left, right))"""
        ways, at = [[] for _ in hashes], list(range(len(hashes)))
        while len(hashes) > 1:
            for k, p in enumerate(at):
                lo = p // run * run
                ways[k].append(("".join(hashes[lo:p]), "".join(hashes[p + 1 : lo + run])))
            hashes = [h(*hashes[lo : lo + run]) for lo in range(0, len(hashes), run)]
            at = [p // run for p in at]
        return hashes[0], ways

    by_source = defaultdict(list)
    for d in docs:
        by_source[d[3]].append((d[0], leaf(*d), leaf(d[0], d[1] and lower(d[1]), *d[2:]) if d[0] is not None and zlib.crc32(str(d[0]).encode()) % every == 0 else leaf(*d)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        below[s] = climb([x[1] for x in by_source[s]])
    root, above = climb([below[s][0] for s in names]) if names else ("", [])
    out = []
    for s, way in zip(names, above, strict=True):
        for (i, own, shown), first in zip(by_source[s], below[s][1], strict=True):
            folded, proof = shown, ""
            for left, right in first + way:
                folded, proof = h(left, folded, right), proof + left + right
            out.append((i, own, below[s][0], root, proof, folded))
    return out
