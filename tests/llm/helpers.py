"""Fixtures and plain-Python versions shared by the tests of this folder."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def prose(rng, n, vocab=None):
    vocab = vocab or ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    stop = "the of and to a in is that it for".split()
    return " ".join(rng.choice(stop) if rng.random() < 0.3 else rng.choice(vocab) for _ in range(n))


def awkward_docs():
    """Null, empty and blank texts, a very long text, exact and near copies, repeated rows,
    repeated lines, non-ASCII text, a null id."""
    rng = random.Random(5)
    a, b = prose(rng, 120), prose(rng, 150)
    near = a.split()
    near[10], near[70] = "changed", "words"
    shared = "This very line is shared by many of the documents here. "
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "One TWO three"), (6, a), (7, a), (8, " ".join(near)),
        (9, b + "\n" + shared), (10, "über straße\n  " + shared.upper() + "\nfin"), (11, shared + "\nx"), (12, shared + "\n" + shared),
        (13, shared + "\r\nq"), (14, prose(rng, 20000)), (15, "ab " * 300), (15, "ab " * 300), (None, b), (16, "é" * 150 + a[:260]),
        (17, "word \x1c odd\x0bspace end " + a), (18, "\n\n\n"), (19, "z " * 49 + "z"), (20, b[:400] + " tail of its own " + a[:300]),
    ]
    return [(i, t, "en", f"src{n % 2}", len(t or "")) for n, (i, t) in enumerate(rows)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def shingle_sets(rows):
    out = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(FOLD))
        out.append((i, frozenset([tuple(w[k:k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else []))))
    return out


def jaccard_components(rows):
    """(n_shingles, component) per row; rows with a null id have a null component."""
    sets = shingle_sets(rows)
    par = {i: i for i, _ in sets if i is not None}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    named = [(i, s) for i, s in sets if i is not None and s]
    for n, (i, s) in enumerate(named):
        for j, t in named[:n]:
            if 100 * len(s & t) >= 75 * len(s | t):
                a, b = find(i), find(j)
                par[max(a, b)] = min(a, b)
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def repeats(texts):
    """(n_bytes, n_removed, n_spans, kept) per text."""
    raw = [(t or "").encode() for t in texts]
    n = Counter(b[p:p + 200] for b in raw for p in range(len(b) - 199))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if n[b[p:p + 200]] > 1:
                gone[p:p + 200] = b"\1" * 200
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def line_dedup(rows, min_chars=40, min_docs=5):
    """(id, n_lines, n_dropped, kept text) per row."""
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
        return k if len(k) >= min_chars else None

    holders = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")} - {None}:
            holders[k].append(i)
    keep = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in keep or keep[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    w = WORD.findall(text or "")
    win = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    n = Counter(win)
    cover = {k + o for k, x in enumerate(win) if n[x] > 1 for o in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover),
            len(w) < 50 or 100 * len(cover) > 50 * len(w))
