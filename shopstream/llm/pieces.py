"""Exact, fast token ids for byte-level BPE vocabularies of ``tokenizers``.

A byte-level BPE splits a text into pieces (letters, digits, punctuation,
white space) and encodes every piece by itself, so the ids of a text are the
ids of its pieces, one after the other.  :class:`PieceEncoder` finds the
pieces of a whole batch of texts with numpy, looks each one up in a table of
bounded size, and lets the library encode only pieces it has not seen.

Texts that this shortcut can't treat (special token strings, characters whose
class depends on the Unicode version) and vocabularies of another kind go to
the library whole; the ids are the same either way.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache

import numpy as np

WS, LETTER, NUMBER, OTHER, UNSURE = 0, 1, 2, 3, 9
SPACE, QUOTE = 0x20, 0x27
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
MAX_PIECE = 64          # longer pieces are encoded each time, not kept
CHUNK_CHARS = 1 << 20   # texts are taken together up to so many characters


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point; UNSURE where Unicode versions may differ."""
    old = unicodedata.ucd_3_2_0
    white = {9, 10, 11, 12, 13, 0x20, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F,
             0x3000, *range(0x2000, 0x200B)}
    kind = {"L": LETTER, "N": NUMBER}
    out = np.full(0x110000, UNSURE, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        now, then = unicodedata.category(c), old.category(c)
        if now[0] == then[0] and now != "Cn":
            out[cp] = kind.get(now[0], OTHER)
    out[list(white)] = WS
    return out


_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG_SPAN = 256         # bytes; longer spans are hashed by the library, one by one


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``values[start:end]``, never 0: eight bytes at a
    time, mixed in between, so no family of texts collides by its structure.
    Memory goes with the number of spans, not with their bytes."""
    raw = np.ascontiguousarray(values).view(np.uint8)
    begin, size = starts * values.itemsize, (ends - starts) * values.itemsize
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[:len(raw)] = raw
    eight = np.ndarray(len(raw) + 1, np.uint64, buffer=padded, strides=(1,))
    out = size.astype(np.uint64) * np.uint64(BASE)
    left = np.flatnonzero(size <= LONG_SPAN)
    at, room, h = begin[left], size[left], out[left]
    with np.errstate(over="ignore"):
        while len(left):
            part = eight[at] & _LOW_BYTES[np.minimum(room, 8)]
            h = mix((h ^ part) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D))
            last = room <= 8
            out[left[last]] = h[last]
            left, at, room, h = left[~last], at[~last] + 8, room[~last] - 8, h[~last]
    far = np.flatnonzero(size > LONG_SPAN)
    if len(far):
        import xxhash

        view = memoryview(raw)
        out[far] = [xxhash.xxh3_64_intdigest(view[a:e])
                    for a, e in zip(begin[far].tolist(), (begin + size)[far].tolist(), strict=True)]
    out[out == 0] = 1
    return out


WINDOW_BLOCK = 1 << 18


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, np.uint64), np.full(n, BASE_INV, np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up), np.cumprod(down)


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all windows of ``size`` values, from each position;
    rolled over blocks of bounded length."""
    n = len(values) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    up, down = _powers(WINDOW_BLOCK + size)
    with np.errstate(over="ignore"):
        for a in range(0, n, WINDOW_BLOCK):
            e = min(n, a + WINDOW_BLOCK)
            part = values[a:e + size - 1].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * up[:len(part)], out=sums[1:])
            out[a:e] = mix((sums[size:] - sums[:e - a]) * down[:e - a])
    out[out == 0] = 1
    return out


class _Table:
    """Open-addressing map from piece hashes to runs of ids, of bounded size."""

    def __init__(self, bits: int):
        self.mask, self.limit = (1 << bits) - 1, 1 << (bits - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.mask + 1, np.uint64)
        self.slot_at = np.zeros(self.mask + 1, np.int32)
        self.begin, self.count = np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.pool, self.used, self.n = np.zeros(4096, np.uint32), 0, 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 where it isn't known."""
        out = np.full(len(h), -1, np.int32)
        slot = (h & np.uint64(self.mask)).astype(np.int64)
        k = self.keys[slot]
        hit = k == h
        out[hit] = self.slot_at[slot[hit]]
        left = np.flatnonzero(~hit & (k != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            k = self.keys[slot[left]]
            hit = k == h[left]
            out[left[hit]] = self.slot_at[slot[left[hit]]]
            left = left[~hit & (k != 0)]
        return out

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])

    def add(self, h: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """New, distinct hashes with the ids of each, one run after another."""
        n, m = self.n + len(h), self.used + len(ids)
        self.begin, self.count = self._room(self.begin, n), self._room(self.count, n)
        self.pool = self._room(self.pool, m)
        self.pool[self.used:m] = ids
        self.count[self.n:n] = counts
        self.begin[self.n:n] = self.used + np.cumsum(counts) - counts
        at = np.arange(self.n, n, dtype=np.int32)
        slot = (h & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = h[free]
            done = free[self.keys[slot[free]] == h[free]]
            self.slot_at[slot[done]] = at[done]
            left = np.setdiff1d(left, done, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask
        self.n, self.used = n, m


def _is_plain_byte_bpe(spec: dict) -> bool:
    """Whether ids of a text are surely the ids of its pieces."""
    pre, model, post = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("post_processor")
    return (spec.get("normalizer") is None and post is None and not spec.get("truncation")
            and not spec.get("padding") and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and model.get("type") == "BPE" and not model.get("dropout"))


class PieceEncoder:
    """``encode`` and ``count`` of one ``.json`` vocabulary, without added ids.

    ``bits`` bounds the table: at most ``2**(bits-1)`` pieces are kept; a full
    table is emptied, which costs time only.  With ``special_as_text`` special
    token strings in a text are encoded like any other text.
    """

    def __init__(self, path: str, bits: int = 21, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.plain = _is_plain_byte_bpe(spec)
        self.special = [] if special_as_text else [t["content"] for t in spec.get("added_tokens", [])]
        self.table = _Table(bits)

    # ------------------------------------------------------------- library
    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _new_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces: words after a space are encoded many at a
        time, as such a run of text splits into the same pieces again."""
        words = [i for i, p in enumerate(pieces) if p[0] == " " and p[1:].isascii() and p[1:].isalpha()]
        ids: list = [None] * len(pieces)
        for a in range(0, len(words), 512):
            part = words[a:a + 512]
            e = self.lib.encode("".join(pieces[i] for i in part), add_special_tokens=False)
            at, got = np.asarray(e.word_ids), np.asarray(e.ids, np.uint32)
            cut = np.searchsorted(at, np.arange(len(part) + 1))
            for k, i in enumerate(part):
                ids[i] = got[cut[k]:cut[k + 1]]
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(rest, self._library([pieces[i] for i in rest]), strict=True):
            ids[i] = np.asarray(x, np.uint32)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return counts, np.concatenate(ids) if ids else np.zeros(0, np.uint32)

    # -------------------------------------------------------------- pieces
    def _starts(self, cp: np.ndarray, cls: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pieces start; ``first`` marks the first character of a text."""
        n = len(cp)
        start = np.ones(n, bool)
        start[1:] = (cls[1:] != cls[:-1]) | first[1:]
        ws = cls == WS
        # the last white space before something else is apart from its run,
        # and a plain space belongs to what follows
        last = np.flatnonzero(ws[:-1] & ~ws[1:] & ~first[1:])
        start[last] = True
        start[last[cp[last] == SPACE] + 1] = False
        quotes = np.flatnonzero((cp == QUOTE) & start)
        if len(quotes):
            self._contractions(cp, first, start, quotes)
        return np.flatnonzero(start)

    @staticmethod
    def _contractions(cp, first, start, quotes) -> None:
        n = len(cp)
        begins = np.append(np.flatnonzero(first), n)
        end = begins[np.searchsorted(begins, quotes, side="right")]
        at = lambda k: np.where(quotes + k < end, cp[np.minimum(quotes + k, n - 1)], 0)
        a, b = at(1), at(2)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for found, size in ((one, 2), (two, 3)):
            q, e = quotes[found], end[found]
            start[q + 1] = False
            after = q + size
            # white space after it was judged already; letters go on as a piece
            after = after[after < e]
            joined = np.zeros(len(after), bool)
            start[after[~joined]] = True

    def _chunk(self, texts: list[str]):
        """Index of each piece in the table, and how many pieces each text has;
        None for the index where a text goes to the library whole."""
        text = "".join(texts)
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(cp):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        cls = _classes()[cp]
        begin = np.cumsum(lens) - lens
        first = np.zeros(len(cp), bool)
        first[begin[lens > 0]] = True
        starts = self._starts(cp, cls, first)
        ends = np.append(starts[1:], len(cp))
        h = span_hashes(cp, starts, ends)
        at = self.table.find(h)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            new, where = np.unique(h[miss], return_index=True)
            where = miss[where]
            short = (ends - starts)[where] <= MAX_PIECE
            if self.table.n + len(new) > self.table.limit:
                self.table.clear()
                if len(new) > self.table.limit // 2:
                    return None
                return self._chunk(texts)
            where = where[short] if not short.all() else where
            if len(where):
                pieces = [text[s:e] for s, e in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
                self.table.add(h[where], *self._new_pieces(pieces))
            at[miss] = self.table.find(h[miss])
            if not short.all():
                return None
        edge = np.searchsorted(starts, np.append(begin, len(cp)))
        return at, np.diff(edge)

    def _plain_texts(self, texts: list[str]) -> np.ndarray:
        """Which texts the pieces give exactly."""
        if not self.plain:
            return np.zeros(len(texts), bool)
        table, ok = _classes(), np.ones(len(texts), bool)
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                ok[i] = False
            elif not t.isascii():
                cp = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
                ok[i] = not (table[cp] == UNSURE).any()
        return ok

    def _runs(self, texts: list[str]):
        """Chunks ``(texts, found)``; found is None where the library encodes."""
        ok = self._plain_texts(texts)
        a = 0
        while a < len(texts):
            b, size = a + 1, len(texts[a])
            while b < len(texts) and ok[b] == ok[a] and size + len(texts[b]) <= CHUNK_CHARS:
                size += len(texts[b])
                b += 1
            part = texts[a:b]
            yield part, self._chunk(part) if ok[a] else None
            a = b

    def count(self, texts: list[str]) -> np.ndarray:
        out = []
        for part, found in self._runs(texts):
            if found is None:
                out.append(np.fromiter(map(len, self._library(part)), np.int64, len(part)))
            else:
                at, pieces = found
                total = np.append(0, np.cumsum(self.table.count[at], dtype=np.int64))
                out.append(np.diff(total[np.append(0, np.cumsum(pieces))]))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and how many each text has."""
        ids, counts = [], []
        for part, found in self._runs(texts):
            if found is None:
                got = self._library(part)
                counts.append(np.fromiter(map(len, got), np.int64, len(part)))
                ids += [np.asarray(x, np.uint32) for x in got]
            else:
                at, pieces = found
                n = self.table.count[at].astype(np.int64)
                before = np.cumsum(n) - n
                where = np.repeat(self.table.begin[at] - before, n) + np.arange(int(n.sum()))
                ids.append(self.table.pool[where])
                total = np.append(0, np.cumsum(n))
                counts.append(np.diff(total[np.append(0, np.cumsum(pieces))]))
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32),
                np.concatenate(counts) if counts else np.zeros(0, np.int64))


class SentencePieceEncoder(PieceEncoder):
    """The same for a sentencepiece ``.model`` that marks spaces in front of
    words: texts are given with a space in front, which stands for the one that
    the model adds.  Where no piece of the vocabulary holds a space mark behind
    another character, and the text is not normalised, nothing is merged over
    the beginning of a run of spaces, so such runs start the pieces here.
    Texts that hold the mark itself, and other models, go to the library whole.
    """

    MARK = "\u2581"

    def __init__(self, path: str, bits: int = 21):
        self.lib = _sentencepiece(path)
        pieces = [self.lib.id_to_piece(i) for i in range(self.lib.vocab_size())]
        probe = "  a  \ufb01 e\u0301\t\u3000\uff21 "
        kept = "".join(self.lib.encode(probe, out_type=str)).replace("<0x09>", "\t")
        self.plain = (kept == self.MARK + probe.replace(" ", self.MARK)
                      and not any(self.MARK in p.lstrip(self.MARK) for p in pieces))
        self.mark_id = self.lib.piece_to_id(self.MARK)
        self.table = _Table(bits)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return self.lib.encode([t[1:] for t in texts], num_threads=1) if texts else []

    def _new_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [x if p != " " else [self.mark_id] for p, x in zip(pieces, self._library(pieces), strict=True)]
        return (np.fromiter(map(len, ids), np.int64, len(ids)),
                np.fromiter((i for x in ids for i in x), np.uint32))

    def _starts(self, cp: np.ndarray, cls: np.ndarray, first: np.ndarray) -> np.ndarray:
        space = cp == SPACE
        start = space.copy()
        start[1:] &= ~space[:-1]
        return np.flatnonzero(start | first)

    def _plain_texts(self, texts: list[str]) -> np.ndarray:
        return np.array([self.plain and self.MARK not in t and t != " " for t in texts], bool)


@lru_cache(maxsize=4)
def encoder(path: str, special_as_text: bool = False) -> PieceEncoder:
    """One encoder for each vocabulary and Python worker; its table is kept
    between tasks."""
    return PieceEncoder(path, special_as_text=special_as_text)


@lru_cache(maxsize=2)
def sentencepiece_encoder(path: str) -> SentencePieceEncoder:
    return SentencePieceEncoder(path)


@lru_cache(maxsize=4)
def _sentencepiece(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_tokens(path: str, texts: list[str]) -> np.ndarray:
    """Tokens of each text: ``.json`` by tokenizers, ``.model`` by sentencepiece."""
    if path.endswith(".model"):
        got = _sentencepiece(path).encode(texts, num_threads=1) if texts else []
        return np.fromiter(map(len, got), np.int64, len(texts))
    return encoder(path).count(texts)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
