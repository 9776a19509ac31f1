"""Periodic runs of words, found with a suffix automaton and link-cut access.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends;
it counts if it has at least ``min_length`` words and ``min_repeats`` periods.

1. Stretches that cannot hold a run are cut out first, with sums over whole groups of
   texts: inside a run every three words in a row come back ``min_repeats - 1`` times or
   more, so a stretch is kept while each of its word triples has that many copies in it.
   Copies are counted by hash; a collision only keeps a stretch longer, so nothing is lost.
2. The suffix automaton of each stretch gives the tree of its suffix links.  Words are
   taken in order: access to a prefix's node walks the solid paths from it to the root.
   Each solid path is one segment of suffixes with the same last end ``e``; at end ``i``,
   the distance ``d = i - e`` within the segment's range of lengths means that the last
   ``d`` words equal the ``d`` words before them, a square whose root is primitive (a
   shorter period would have a later end).  The access makes the whole path one segment
   with last end ``i``.  Splay trees hold the paths: O(log n) amortised a word.
3. The first square of a period that lies behind the last run of this period is extended
   word by word to its run.

Texts do not meet: nothing is shuffled, and a task holds one group of texts.

Defined results: a null, empty or blank text has no words and no runs; repeated rows and
null ids are rows of their own; an empty table gives an empty result; extra columns are
ignored; texts of any length are searched in whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfeat.llm.common import words

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
GROUP_CHARS = 1 << 21  # texts of about so many characters are searched together
ROUNDS = 8  # of step 1; each only makes the stretches shorter
_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_tree(seq: list) -> tuple[list[int], list[int], list[int]]:
    """``(link, length, prefix)`` of the suffix automaton: suffix link and longest length
    of each state, and the state of each prefix.  State 0 is the start."""
    step, link, length, prefix, last = [{}], [-1], [0], [], 0
    for word in seq:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        prefix.append(new)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            old = step[at][word]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                twin = len(step)
                step.append(step[old].copy())
                link.append(link[old])
                length.append(length[at] + 1)
                link[old] = link[new] = twin
                while at >= 0 and step[at].get(word) == old:
                    step[at][word] = twin
                    at = link[at]
        last = new
    return link, length, prefix


class LastEnds:
    """Forest of suffix links with a last end for each solid path (-1: none yet)."""

    def __init__(self, link: list[int], length: list[int]):
        self.up = [max(x, 0) for x in link]  # splay parent, or the node above a path's top; 0: none
        self.left = [0] * len(link)
        self.right = [0] * len(link)
        self.end = [-1] * len(link)  # valid at splay roots
        self.length = length

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y], up[x] = x, z
        if left[z] == y and z:
            left[z] = x
        elif right[z] == y and z:
            right[z] = x

    def _splay(self, x: int) -> None:
        up, left, right, rotate = self.up, self.left, self.right, self._rotate
        while (y := up[x]) and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                self.end[x] = self.end[z]  # counts if z was the root
                rotate(y if (left[z] == y) == (left[y] == x) else x)
            else:
                self.end[x] = self.end[y]  # y was the root
            rotate(x)

    def access(self, node: int, end: int) -> list[tuple[int, int]]:
        """``(last end, longest length)`` of each segment from ``node`` to the root, which
        all become one segment with last end ``end``."""
        segments, below, at = [], 0, node
        while at:
            self._splay(at)
            segments.append((self.end[at], self.length[at]))
            cut = self.right[at]
            if cut:
                self.end[cut] = self.end[at]  # the lower part is a path of its own
            self.right[at] = below
            below, at = at, self.up[at]
        self._splay(node)
        self.end[node] = end
        return segments


def runs_of(seq: list, min_length: int = 6, min_repeats: int = 4) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a sequence, by start, then period."""
    link, length, prefix = suffix_tree(seq)
    ends, n = LastEnds(link, length), len(seq)
    done: dict[int, int] = {}  # last word of the last run of each period
    out = []
    for i, node in enumerate(prefix):
        segments = ends.access(node, i)
        segments.append((-1, 0))
        for (e, longest), (_, shorter) in zip(segments, segments[1:]):
            d = i - e
            if e < 0 or not shorter < d <= longest or done.get(d, -1) >= i:
                continue
            a, b = i - 2 * d + 1, i
            while a and seq[a - 1] == seq[a - 1 + d]:
                a -= 1
            while b + 1 < n and seq[b + 1] == seq[b + 1 - d]:
                b += 1
            done[d] = b
            if b - a + 1 >= max(min_length, min_repeats * d):
                out.append((a, b - a + 1, d))
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(ids, texts, min_length: int, min_repeats: int):
    """``(start, stop)`` arrays of the stretches of ``ids`` (the words of many texts, one
    behind the other; ``texts`` has the text number of each) that may hold a run."""
    import numpy as np

    none = np.zeros(0, "i8")
    if len(ids) < 3:
        return none, none
    with np.errstate(over="ignore"):
        x = ids.astype("u8")
        h = (x[:-2] * np.uint64(0x9E3779B97F4A7C15) + x[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + x[2:]
        at = np.flatnonzero(texts[2:] == texts[:-2])  # triples inside one text
        group = texts[at]
        copies, least = min(min_repeats - 1, max(min_length, min_repeats) - 2), max(min_length - 2, 1)
        for _ in range(ROUNDS):
            before = len(at)
            if not before:
                return none, none
            bits = max(8, int(8 * before).bit_length())
            slot = ((h[at] ^ group.astype("u8") * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)).astype("i8")
            keep = np.bincount(slot, minlength=1 << bits)[slot] >= copies
            at, group = at[keep], group[keep]
            if not len(at):
                return none, none
            opens = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(group) != 0)))
            group = np.cumsum(opens) - 1
            keep = np.bincount(group)[group] >= least
            at, group = at[keep], group[keep]
            if len(at) == before:
                break
    first = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0))) if len(at) else none
    last = np.concatenate((first[1:], [len(at)])) - 1 if len(at) else none
    return at[first], at[last] + 3


def _found(min_length: int, min_repeats: int):
    def search(texts: list[str | None]) -> list[tuple]:
        """``(n_words, runs, collapsed)`` of each text."""
        import numpy as np

        numbers: dict[str, int] = {}
        split = [_WORD.findall(t or "") for t in texts]
        ids = np.array([numbers.setdefault(w, len(numbers)) for ws in split for w in ws], "i8")
        sizes = np.array([len(ws) for ws in split])
        base = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(split)), sizes)
        runs: list[list] = [[] for _ in split]
        for a, b in zip(*(x.tolist() for x in stretches(ids, owner, min_length, min_repeats))):
            k = int(owner[a])
            runs[k] += [(s + a - int(base[k]), n, q) for s, n, q in runs_of(ids[a:b].tolist(), min_length, min_repeats)]
        out = []
        for ws, found in zip(split, runs):
            found.sort(key=lambda r: (r[0], r[2]))
            kept = ws
            if found:
                stay = np.ones(len(ws), bool)
                for s, n, q in found:
                    stay[s + q:s + n] = False
                kept = [w for w, x in zip(ws, stay.tolist()) if x]
            out.append((len(ws), found, " ".join(kept)))
        return out

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for b in batches:
            sizes, at = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist(), 0
            while at < b.num_rows:  # a few texts at a time: bounded memory
                stop, total = at + 1, sizes[at]
                while stop < b.num_rows and total + sizes[stop] <= GROUP_CHARS:
                    total += sizes[stop]
                    stop += 1
                rows = b.slice(at, stop - at)
                got = search(rows.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array([x[0] for x in got], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in x[1]] for x in got], pa.list_(one)),
                    pa.array([x[2] for x in got], pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
                at = stop

    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_repeats: int = 4) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: all runs of each text by start, then period,
    and its words without those behind the first period of a run."""
    if min_repeats < 2 or min_length < 2:
        raise ValueError("a run has at least two periods and two words")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_found(min_length, min_repeats), _SCHEMA)


def with_periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's damage: a tenth of the texts, chosen by the CRC of the decimal id,
    repeat a period of their words from some word on (Spark expressions only; a text with a
    null id stays)."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    ws = words(F.col(text_col))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))
    g, n = F.floor(F.col("h") / 10), F.size(ws)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycle = F.slice(ws, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(cycle, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    whole = F.array_join(F.concat(F.slice(ws, F.lit(1), a), tail), " ")
    return d.select("doc_id", F.when(F.col("h") % 10 == 0, whole).otherwise(F.col("text")).alias("text"))


def run_report(found: DataFrame) -> DataFrame:
    """Count, strongest run and digests of ``find_runs``."""
    first = F.get("runs", F.lit(0))
    # exact comparison of length / period; earlier runs win ties, as runs are in order
    best = F.aggregate("runs", first, lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    d = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                     F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
    return d.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                    F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256", "n_words")
