"""Rows with everything that may go wrong, and plain versions of the operators."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

#: The columns of documents, and some whose names clash with results.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, doc string, n_words int, "
          "spans string, `odd.name` int, `key` string")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@lru_cache
def _made():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = text(300)
    near = base.split(" ")
    near[150] = "changed"
    passage = text(120)
    item = " ".join(base.split(" ")[40:70])
    license_line = "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3."
    texts = [
        None, "", " ", "\n\n", "one", "one", "two words", "?!", base, base, " ".join(near), base.upper(),
        text(40) + "\n" + passage + "\n" + text(40), text(30) + " " + passage, passage, passage[:500] + passage[:500],
        text(200) + "\n" + license_line, "by\n" + license_line + "\nAll rights\nreserved.", "CC\tBY", "cc by" * 3,
        "a" * 1000, "a" * 400, "a" * 399, "é" * 500, "中文字" * 300, "<|endoftext|> it's <|endoftext|>", item, item + " " + item,
        "Kİ \x00 \x1c", "x " * 60000, text(20000), text(30) + " " + item + " " + text(100)]
    lines = [text(30) for _ in range(6)]
    edited = lines[0].split(" ")
    edited[10] = edited[10] + "x"
    texts += ["\n".join(lines), "\n".join(lines[:3]) + "\nnew " + text(9), " ".join(edited) + "\n" + lines[1], "\n".join([lines[5]] * 4)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, base), (None, None), (40, "same row"), (40, "same row"), (60, text(64))]
    return rows, item, vocabulary


def rows():
    return [(i, t, None if (i or 0) % 3 else "en", None, None if t is None else len(t), 0.5, "x", 7, None, i, "k")
            for i, t in _made()[0]]


def texts():
    return _made()[0]


def items():
    item = _made()[1]
    return [(7, item, 0.1), (12, "one", 0.2), (12, "one", 0.2), (3, None, None), (None, "two words", 0.0), (5, "", 1.0),
            (100, "never seen " * 20, 0.0)]


def labels():
    return [(i, int(i % 4 != 0), 0) for i in range(40)] + [(None, 1, 0), (5, None, None), (6, 0, 0), (9999, 1, 0)]


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def token_ids(vocabulary, values):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(vocabulary).encode_batch([t or "" for t in values], add_special_tokens=False)]


def repeated(values, length, first=False):
    """Per text: bytes that stay, removed bytes, spans; with ``first`` the
    first of equal strings stays."""
    raw = [(t or "").encode() for t in values]
    seen, total = set(), Counter(r[k:k + length] for r in raw for k in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            w = r[k:k + length]
            if (w in seen) if first else total[w] > 1:
                gone[k:k + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def contamination(values, benchmark, size=13):
    windows = defaultdict(set)
    for item, text, *_ in benchmark:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add("" if item is None else str(item))
    out = []
    for t in values:
        w, found = words(t), set()
        hit = [False] * len(w)
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k:k + n])):
                    found |= got
                    hit[k:k + n] = [True] * n
        out.append((len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def base_places(text):
    from shopstream.llm.licenses import BASE

    w = words(text)
    return len(w), [(i, label) for phrase, label in BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def of(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def link(self, a, b):
        a, b = sorted((self.of(a), self.of(b)))
        self.up[b] = a


def near_classes(pairs, threshold=0.8):
    """doc_id -> class of (doc_id, text) pairs, by comparing all of them."""
    sets = {i: shingles(t) for i, t in pairs}
    groups = Groups(sets)
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            s, t = sets[a], sets[b]
            if (not s and not t) or (s and t and len(s & t) >= threshold * len(s | t)):
                groups.link(a, b)
    return {i: groups.of(i) for i in ids}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


# ------------------------------------------------------------- operator 11
def _token_bytes():
    import json

    import public_tokenizers
    import sentencepiece

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    a = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if all(c in letters for c in t)}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    b = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("\u2581", " ").encode()
    return a, b, sp


def alignment_groups(text):
    """[(ids of A, ids of B), ...] of one text, by walking both cuttings."""
    import public_tokenizers
    from tokenizers import Tokenizer

    if not text:
        return []
    a_bytes, b_bytes, sp = _token_bytes()
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    a, b, raw = lib.encode(" " + text, add_special_tokens=False).ids, sp.encode(text), (" " + text).encode()
    if b"".join(a_bytes[i] for i in a) != raw or b"".join(map(b_bytes, b)) != raw:
        return []
    out, at, end_a, end_b = [([], [])], [0, 0], 0, 0
    while at[0] < len(a) or at[1] < len(b):
        if end_a <= end_b and at[0] < len(a) and (end_a < end_b or not out[-1][0]):
            end_a += len(a_bytes[a[at[0]]])
            out[-1][0].append(a[at[0]])
            at[0] += 1
        else:
            end_b += len(b_bytes(b[at[1]]))
            out[-1][1].append(b[at[1]])
            at[1] += 1
        if end_a == end_b:
            out.append(([], []))
    return out[:-1]


def aligned(values):
    """Rows of operator 11 without doc_id; every value is a document."""
    each = [alignment_groups(t) for t in values]
    count = Counter()
    for g in each:
        count.update({(x, y) for a, b in g for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for g in each:
        links = [(x, y) for a, b in g for x in a for y in b]
        named = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(named.encode()).hexdigest() if g else ""))
    return out


# ------------------------------------------------------------- operator 12
def languages(rows):
    """doc_id -> held_out, lang_pred, score of (doc_id, text, lang), by a plain
    naive Bayes over the same features."""
    import math

    from shopstream.llm.language import BUCKETS, SMOOTHING, features

    rest = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 4
    of = lambda t: features([t or ""])[0].tolist()
    n, docs = defaultdict(Counter), Counter()
    for i, t, lang in rows:
        if i is not None and lang is not None and rest(i) != 2:
            n[lang].update(of(t))
            docs[lang] += 1
    out = {}
    size = {x: math.log(sum(n[x].values()) + SMOOTHING * BUCKETS) for x in docs}
    for i, t, _ in rows:
        f = Counter(of(t))
        if not f or not docs:
            out[i] = (rest(i) == 2, "und", 0.0)
            continue
        each = {x: math.log(docs[x] / sum(docs.values())) + sum(c * (math.log(n[x][k] + SMOOTHING) - size[x]) for k, c in f.items())
                for x in docs}
        best = min(docs, key=lambda x: (-each[x], x))
        out[i] = (rest(i) == 2, best, 1 / sum(math.exp(v - each[best]) for v in each.values()))
    return out


# ------------------------------------------------------------- operator 13
def collocations(rows, top, least):
    """Rows of operator 13 of (text, lang) pairs."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang in n:
        if not n[lang]:
            continue
        c = {p: x for p, x in f[lang].items() if len(p) > 1 and x >= least}
        kept = []
        for p, a in c.items():
            score, k = min((2000000 * a // (f[lang][p[:k]] + f[lang][p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in c.items()):
                kept.append((-score, -a, " ".join(p).encode(), k, p))
        for rank, (score, a, text, k, p) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, text.decode(), -a, f[lang][p[:k]], f[lang][p[k:]], n[lang], -score, k))
    return sorted(out)
