"""Token ids of whole texts by a public byte-level BPE vocabulary.

Byte-level BPE cuts a text into pieces (a run of letters, digits or other signs with the space
before it, or white space) and merges inside a piece only, so equal pieces have equal ids.
Pieces are found with numpy, each distinct one is encoded once by the tokenizers library, and
the ids of a text are gathered from them. A hash groups a block's pieces and finds those already known;
each is then compared character by character, with the first of its group and with the known one. What is
known stands in flat arrays, since a worker keeps millions of pieces. Texts with characters beyond U+024F or
with a special token's string go to the library whole, so classes of rarer characters are the library's own.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from .textbytes import mix, powers

#: Texts are joined into blocks of about this many characters.
BLOCK_CHARS = 1 << 18
#: and never of more texts than this
BLOCK_ROWS = 1024
#: A worker forgets its pieces when it knows this many, or this many characters of them; it changes no result.
MOST_PIECES = 2_000_000
MOST_CHARS = 32 << 20
_PLAIN = 0x250
_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _classes() -> np.ndarray:
    kinds = np.full(_PLAIN, _OTHER, np.uint8)
    for code in range(_PLAIN):
        kind = unicodedata.category(chr(code))[0]
        kinds[code] = {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)
    kinds[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0]] = _SPACE
    return kinds


def piece_starts(code: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where pieces begin in joined texts of characters below U+0250; off: where texts begin, and the end."""
    n = len(code)
    kind = _classes()[code]
    space = kind == _SPACE
    head = np.zeros(n + 1, bool)
    head[off] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 0, kind[:-1]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = code[:-1] == 0x20
    changes = head[:n] | (kind != before)
    next_solid = np.zeros(n, bool)
    next_solid[:-1] = ~space[1:]
    next_solid &= ~head[1:]
    start = np.where(space, changes | next_solid, changes & ~(blank_before & ~head[:n]))
    # 's 't 're 've 'm 'll 'd are pieces of their own where a piece begins with the apostrophe
    marks = np.flatnonzero(code == 0x27)
    if len(marks):
        opens = head[marks] | (before[marks] == _LETTER) | (before[marks] == _NUMBER) | ((before[marks] == _SPACE) & ~blank_before[marks])
        marks = marks[opens]
        left = off[np.searchsorted(off, marks, "right")] - marks - 1
        padded = np.concatenate([code, np.zeros(2, code.dtype)])
        one, two = np.where(left >= 1, padded[marks + 1], 0), np.where(left >= 2, padded[marks + 2], 0)
        size = np.zeros(len(marks), np.int64)
        size[np.isin(one, [ord(c) for c in "stmd"])] = 1
        for a, b in ("re", "ve", "ll"):
            size[(one == ord(a)) & (two == ord(b))] = 2
        marks, size = marks[size > 0], size[size > 0]
        start[marks + 1] = False
        after = marks + 1 + size
        inner = after < n
        after = after[inner]
        after = after[kind[after] == _LETTER]
        start[after] = True
    return np.flatnonzero(start)


class _Row:
    """A flat array that grows at its end; n of it is filled."""

    def __init__(self, kind: type, first: tuple[int, ...] = ()):
        self.n, self.all = len(first), np.array([*first, *[0] * 64], kind)

    def extend(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self.all):
            wider = np.empty(need + need // 4, self.all.dtype)
            wider[: self.n] = self.all[: self.n]
            self.all = wider
        self.all[self.n : need] = more
        self.n = need


class _Known:
    """Pieces by number: their characters and ids end to end, and an open table of their hashes."""

    def __init__(self) -> None:
        self.key, self.ids, self.signs = _Row(np.uint64), _Row(np.int32), _Row(np.uint16)
        self.id_ends, self.sign_ends = _Row(np.int64, (0,)), _Row(np.int64, (0,))
        self.table = np.full(1 << 12, -1, np.int32)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The number of the piece of each hash, or -1."""
        found, left, at = np.full(len(key), -1, np.int64), np.arange(len(key)), self._home(key)
        while len(left):
            number = self.table[at]
            same = (number >= 0) & (self.key.all[number] == key[left])
            found[left[same]] = number[same]
            on = (number >= 0) & ~same
            left, at = left[on], (at[on] + 1) & (len(self.table) - 1)
        return found

    def unlike(self, number: np.ndarray, code: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the piece of each number is another than the one from begin to end of code."""
        size = end - begin
        start = self.sign_ends.all[number]
        other = self.sign_ends.all[number + 1] - start != size
        size = np.where(other, 0, size)
        edge = np.cumsum(size) - size
        step = np.arange(size.sum())
        wrong = code[np.repeat(begin - edge, size) + step] != self.signs.all[np.repeat(start - edge, size) + step]
        other[np.repeat(np.arange(len(size)), size)[wrong]] = True
        return other

    def add(self, pieces: list[str], ids: list[list[int]]) -> np.ndarray:
        """The numbers of new pieces."""
        number = np.arange(self.id_ends.n - 1, self.id_ends.n - 1 + len(pieces))
        for row, ends, parts in ((self.ids, self.id_ends, ids), (self.signs, self.sign_ends, pieces)):
            ends.extend(row.n + np.cumsum([len(x) for x in parts]))
        self.ids.extend(np.fromiter(chain.from_iterable(ids), np.int32))
        self.signs.extend(np.frombuffer("".join(pieces).encode("utf-16-le"), np.uint16))
        self.key.extend(np.zeros(len(pieces), np.uint64))
        return number

    def enter(self, key: np.ndarray, number: np.ndarray) -> None:
        """From now on the hashes, none of which is there yet, find these numbers."""
        self.key.all[number] = key
        if 2 * self.key.n > len(self.table):
            old = self.table[self.table >= 0]
            self.table = np.full(1 << int(4 * self.key.n).bit_length(), -1, np.int32)
            self._put(self.key.all[old], old)
        self._put(key, number)

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (key & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _put(self, key: np.ndarray, number: np.ndarray) -> None:
        at = self._home(key)
        while len(number):
            free = self.table[at] < 0
            self.table[at[free]] = number[free]
            # of pieces that want one place, one has it and the others go on
            on = self.table[at] != number
            number, at = number[on], (at[on] + 1) & (len(self.table) - 1)


class Encoder:
    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known = _Known()
        #: pieces whose hash another one has
        self.others: dict[str, int] = {}

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> np.ndarray:
        return self.known.add(pieces, [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)])

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(slot of every piece, first piece of every text and the end), for plain texts."""
        joined = "".join(texts)
        off = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=off[1:])
        if not joined:
            return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        begin = piece_starts(code, off)
        end = np.append(begin[1:], len(code))
        up, down = powers(len(code))
        total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code.astype(np.uint64) + np.uint64(1)) * up[: len(code)], out=total[1:])
        key = mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        if self.known.key.n > MOST_PIECES or self.known.signs.n > MOST_CHARS:
            self.forget()
        cut = lambda which: [joined[a:b] for a, b in zip(begin[which].tolist(), end[which].tolist(), strict=True)]
        slots = self.known.find(key[first])
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self._learn(cut(first[new]))
            self.known.enter(key[first[new]], slots[new])
        odd = first[self.known.unlike(slots, code, begin[first], end[first])]
        slots = slots[which]
        # other pieces with the same hash, as one known before or as one of the block
        odd = np.union1d(np.flatnonzero(np.isin(first[which], odd)) if len(odd) else odd, self._unlike(code, begin, end, first[which]))
        if len(odd):
            pieces = cut(odd)
            unknown = [p for p in dict.fromkeys(pieces) if p not in self.others]
            self.others.update(zip(unknown, self._learn(unknown).tolist(), strict=True))
            slots[odd] = [self.others[p] for p in pieces]
        return slots, np.searchsorted(begin, off)

    @staticmethod
    def _unlike(code: np.ndarray, begin: np.ndarray, end: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """The pieces that are not, sign for sign, the one chosen for them."""
        size = end - begin
        unlike = size[chosen] != size
        shift = np.where(unlike, 0, begin[chosen] - begin)
        # pieces follow one another, so signs and pieces run in parallel
        wrong = np.flatnonzero(code[np.arange(len(code)) + np.repeat(shift, size)] != code)
        unlike[np.searchsorted(begin, wrong, "right") - 1] = True
        return np.flatnonzero(unlike)

    def counts_and_ids(self, column: pa.Array | list[str | None], want_ids: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Blocks of (token count of each text, ids of all of them), in order; null is empty.

        Of an Arrow column few texts at a time are taken out.
        """
        for top in range(0, len(column), BLOCK_ROWS):
            some = column[top : top + BLOCK_ROWS]
            texts = [t or "" for t in (some if isinstance(some, list) else some.to_pylist())]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= BLOCK_CHARS):
                    size += len(texts[hi])
                    hi += 1
                yield self._encoded(texts[lo:hi], want_ids)
                lo = hi

    def _plain(self, text: str) -> bool:
        return (text.isascii() or max(text) < chr(_PLAIN)) and not any(s in text for s in self.special)

    def _encoded(self, texts: list[str], want_ids: bool) -> tuple[np.ndarray, np.ndarray | None]:
        odd = {i: t for i, t in enumerate(texts) if t and not self._plain(t)}
        slots, edge = self._block(["" if i in odd else t for i, t in enumerate(texts)])
        begin = self.known.id_ends.all[slots]
        length = self.known.id_ends.all[slots + 1] - begin
        running = np.zeros(len(slots) + 1, np.int64)
        np.cumsum(length, out=running[1:])
        counts = running[edge[1:]] - running[edge[:-1]]
        ids = None
        if want_ids:
            ids = self.known.ids.all[np.repeat(begin - running[:-1], length) + np.arange(running[-1])]
        if odd:
            whole = dict(zip(odd, self._whole(list(odd.values())), strict=True))
            if want_ids:
                pieces, at = [], 0
                for i, n in enumerate(counts.tolist()):
                    pieces.append(whole[i] if i in whole else ids[at : at + n])
                    at += n
                ids = np.concatenate(pieces)
            for i, found in whole.items():
                counts[i] = len(found)
        return counts, ids


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder a worker process and vocabulary."""
    return Encoder(vocabulary)
