"""Periodic runs against a scan of all periods."""

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventfeat.llm import periods
from eventfeat.llm.queries import QUERIES
from tests.llm.helpers import SCHEMA, WORD, awkward_docs, rows_of, sha


def plain_runs(seq, min_length=6, min_repeats=4):
    numbers = {}
    x = np.array([numbers.setdefault(w, len(numbers)) for w in seq])
    out = []
    for q in range(1, len(seq) // min_repeats + 1):
        same = np.flatnonzero(np.diff(np.concatenate(([0], x[q:] == x[:-q], [0]))))
        for i, j in zip(same[::2].tolist(), same[1::2].tolist()):
            size = j - i + q
            if size >= max(min_length, min_repeats * q) and not any((x[i:i + size - z] == x[i + z:i + size]).all() for z in range(1, q)):
                out.append((i, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text):
    """The contract's row for one document."""
    ws = WORD.findall(text or "")
    n = len(ws)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(ws)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    best = (None,) * 4
    for s, size, q in runs:
        if best[0] is None or size * best[2] > best[1] * q:
            best = (s, size, q, 1000 * size // q)
    return (doc_id, len(runs), *best, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
            sha(" ".join(w for k, w in enumerate(ws) if k not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 5), st.integers(0, 30))
def test_runs_match_all_periods(head, period, tail):
    seq = head + [(k % period) + 2 for k in range(tail)]
    for least, repeats in ((6, 4), (2, 2), (5, 3)):
        assert periods.runs_of(seq, least, repeats) == plain_runs(seq, least, repeats)


def test_segments_hold_the_latest_end():
    """Every suffix's last end, read from the segments, equals a search."""
    rng = random.Random(4)
    for _ in range(60):
        seq = [rng.randrange(3) for _ in range(40)]
        link, length, prefix = periods.suffix_tree(seq)
        ends = periods.LastEnds(link, length)
        for i, node in enumerate(prefix):
            segments = ends.access(node, i)
            for size in range(1, i + 2):
                last = max((e for e in range(size - 1, i) if seq[e - size + 1:e + 1] == seq[i - size + 1:i + 1]), default=-1)
                assert [e for e, longest in segments if longest >= size][-1] == last


def test_cutting_loses_no_run(spark):
    rng = random.Random(8)
    rows = []
    for k in range(150):
        ws = [f"w{rng.randrange(rng.choice([2, 4, 300]))}" for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(ws))
            ws[at:at] = [f"w{rng.randrange(6)}" for _ in range(rng.randint(1, 7))] * rng.randint(2, 7)
        rows.append((k, rng.choice([" ", "\n", "\t "]).join(ws)))
    got = {r.doc_id: r for r in periods.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        ws = t.split()
        assert [tuple(r) for r in got[k].runs] == plain_runs(ws)
        gone = {i for s, size, q in plain_runs(ws) for i in range(s + q, s + size)}
        assert got[k].collapsed == " ".join(w for i, w in enumerate(ws) if i not in gone)


def test_whole_query_on_awkward_rows(spark, tmp_path):
    rows = [*awkward_docs(), (30, "a b " * 50), (31, "x " + "q r s " * 9 + "q y"), *((k, f"{'p q r ' * 20}{k}") for k in range(100, 160))]
    rows = [r if len(r) == 5 else (*r, "en", "s", len(r[1] or "")) for r in rows]
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_runs", "2 AS runs").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_run_detection"](spark, str(tmp_path)).drop("n_words")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows_of(got) == sorted((plain_report(r[0], r[1]) for r in rows), key=repr)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None)


def test_empty_table(spark):
    assert periods.run_report(periods.find_runs(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_long_periodic_text_is_fast():
    import time

    began = time.time()
    assert periods.runs_of([k % 1000 for k in range(60_000)]) == [(0, 60_000, 1000)]
    assert periods.runs_of([7] * 60_000) == [(0, 60_000, 1)]
    assert time.time() - began < 20
