"""Repeated passages removed, as a suffix array limited to ``WINDOW`` bytes would find them.

Suffixes are ordered by most-significant digits and never beyond ``WINDOW`` bytes: equal
groups at that depth are exactly the repeated windows.  A group of one is settled and
leaves after each pass.

* First digit (``DIGIT`` bytes).  Of all digits that start in a window, the one with the
  smallest hash stands for it; equal windows choose the same.  The twice-seen filter
  (module ``seen``) keeps the windows whose chosen digit occurs again.
* Windows in a row that chose the same digit form a run.  Runs are written once, each with
  the bytes its windows span, and the windows of each digit are counted.
* Last digit.  Runs are dealt out by digit, and the owner of a digit compares its windows
  in full depth (64-bit hashes made from 8-byte words in seven doubling steps): windows
  found twice are repeated.
* A digit of more than ``LARGE`` windows has no single owner.  A second twice-seen filter
  cuts its runs down to pieces, windows in a row that may occur again.  Equal pieces count
  as one, so a passage that very many texts share is a few pieces.  Windows are counted over
  distinct pieces by (digit, hash), and what is found goes back to the texts by piece.

Texts are addressed by digest, so copies of a whole text are compared once per task, and
a digest that several rows hold is wholly repeated where it has ``WINDOW`` bytes.

Defined results: a null text is empty; nothing is removed from a text below ``WINDOW``
bytes; repeated rows are copies of each other; null ids are carried through; an empty
table gives an empty result; extra columns are ignored.  Removed bytes may cut a UTF-8
character, so kept texts are binary.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventfeat.llm import seen
from eventfeat.llm.common import written

WINDOW = 200
DIGIT = 64
BLOCK = 1 << 21   # bytes of runs that are sent, and compared, at once
HASHED = 1 << 19  # bytes of runs that are hashed at once
LARGE = 1 << 17   # windows of one digit that one task compares
KNOWN = 1 << 16   # pieces that a task remembers as sent


def _mix(h):
    import numpy as np

    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _doubled(a, n: int, step: int):
    """Hash of twice as many bytes at each of ``n`` starts."""
    import numpy as np

    return _mix(a[:n] * np.uint64(0x9E3779B97F4A7C15) + a[step:step + n])


def digits(data):
    """Hashes of the 8, 64 and 128 bytes at every start (numpy arrays of decreasing length)."""
    import numpy as np

    b = data.astype(np.uint64)
    w = b[:max(0, len(b) - 7)].copy()
    for i in range(1, 8):
        w |= b[i:i + len(w)] << np.uint64(8 * i)
    h8 = _mix(w * np.uint64(0x9E3779B97F4A7C15))
    h, size, out = h8, 8, {8: h8}
    while size < 128:
        h = _doubled(h, max(0, len(h) - size), size)
        size *= 2
        out[size] = h
    return out


def windows(out):
    """Hash of the ``WINDOW`` = 128 + 64 + 8 bytes at every start."""
    import numpy as np

    n = max(0, len(out[8]) - (WINDOW - 8))
    m = np.uint64(0x9E3779B97F4A7C15)
    return _mix(_mix(out[128][:n] * m + out[64][128:128 + n]) * m + out[8][192:192 + n])


def chosen(h64):
    """Smallest digit hash inside each window (the digit that stands for the window)."""
    import numpy as np

    span = WINDOW - DIGIT + 1
    m, size = h64, 1
    while size * 2 <= span:
        m = np.minimum(m[:len(m) - size], m[size:])
        size *= 2
    rest = span - size
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def _texts(batches) -> Iterator:
    """(bytes, digest) of the texts that have a window, each distinct one once per task."""
    import numpy as np

    known = set()
    for b in (b.slice(k, 512) for b in batches for k in range(0, b.num_rows, 512)):
        for text, digest in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if text is not None and len(text) * 4 >= WINDOW and digest not in known:
                known.add(digest)
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) >= WINDOW:
                    yield np.frombuffer(raw, np.uint8), digest


def _send(p: seen.Plan):
    def run(batches) -> Iterator:
        import numpy as np

        def arrays():
            for data, _ in _texts(batches):
                h = digits(data)[DIGIT]
                m = chosen(h)
                # every place where a chosen digit stands, also twice in one text
                yield h[np.isin(h, m[np.r_[True, m[1:] != m[:-1]]])]

        return seen.send(arrays(), p)

    return run


def _runs(p: seen.Plan, shared):
    """Rows (digit, bytes, digest, start): windows ``start ..`` of the text chose ``digit``."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("digit", pa.int64()), ("bytes", pa.binary()), ("text", pa.binary()), ("start", pa.int64())])

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        rows, size = [], 0
        for data, digest in _texts(batches):
            m = chosen(digits(data)[DIGIT])
            lo = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
            hi = np.r_[lo[1:], len(m)]
            for n in np.flatnonzero(seen.hits(shared.value, m[lo], p)).tolist():
                a, z = int(lo[n]), int(hi[n]) + WINDOW - 1
                rows.append((int(m[a].view(np.int64)), data[a:z].tobytes(), digest, a))
                size += z - a
            if size >= BLOCK:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)

    return run


def _hashed(held, count):
    """Hashes of the windows that lie in one run (``count``: windows of each run)."""
    import numpy as np

    data = np.frombuffer(b"".join(r[1] for r in held), np.uint8)
    first = np.r_[0, np.cumsum(count + WINDOW - 1)[:-1]]
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return windows(digits(data))[np.repeat(first, count) + at]


def _stretches(hit, owner):
    """First and last of the windows ``hit`` that follow each other in one run."""
    import numpy as np

    new = np.r_[True, (owner[hit][1:] != owner[hit][:-1]) | (hit[1:] != hit[:-1] + 1)]
    return hit[new], hit[np.r_[np.flatnonzero(new)[1:] - 1, len(hit) - 1]]


def _compared(batches) -> Iterator:
    """Rows sorted by digit -> (text, starts and ends of covered bytes)."""
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("text", pa.binary()), ("spans", pa.binary())])

    def settle(held):
        """``held``: whole digit groups."""
        sizes = np.array([len(r[1]) for r in held])
        count = sizes - WINDOW + 1
        owner = np.repeat(np.arange(len(held)), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // HASHED)) + 1  # about HASHED bytes at once
        cuts = [0, *cuts.tolist(), len(held)]
        h = np.concatenate([_hashed(held[a:z], count[a:z]) for a, z in zip(cuts, cuts[1:])])
        # the digit is part of the window, so equal windows have it in common
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        again = np.zeros(len(h), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        hit = np.flatnonzero(again)
        if not len(hit):
            return None
        # runs of repeated windows within one owner become one span
        lo, hi = _stretches(hit, owner)
        by = {}
        for k, a, z in zip(owner[lo].tolist(), at[lo].tolist(), at[hi].tolist()):
            _, _, text, start = held[k]
            by.setdefault(text, []).append((start + a, start + z + WINDOW))
        return pa.RecordBatch.from_arrays([
            pa.array(by.keys(), pa.binary()), pa.array([np.array(v, np.int64).tobytes() for v in by.values()], pa.binary())],
            schema=schema)

    held, size, last = [], 0, None
    for b in batches:
        for row in zip(*(b.column(n).to_pylist() for n in range(4))):
            if row[0] != last and size >= BLOCK:
                out = settle(held)
                if out is not None:
                    yield out
                held, size = [], 0
            last = row[0]
            held.append(row)
            size += len(row[1])
    if held:
        out = settle(held)
        if out is not None:
            yield out


def _blocks(batches) -> Iterator:
    """Runs (digit, bytes, text, start), about ``HASHED`` bytes at once, and their window counts."""
    import numpy as np

    def out():
        return rows, np.array([len(r[1]) for r in rows]) - WINDOW + 1

    rows, size = [], 0
    for b in (b.slice(k, 512) for b in batches for k in range(0, b.num_rows, 512)):
        for row in zip(*(b.column(n).to_pylist() for n in range(4))):
            rows.append(row)
            size += len(row[1])
            if size >= HASHED:
                yield out()
                rows, size = [], 0
    if rows:
        yield out()


def _send_windows(p: seen.Plan):
    def run(batches) -> Iterator:
        return seen.send((_hashed(rows, count) for rows, count in _blocks(batches)), p)

    return run


def _pieces(p: seen.Plan, shared):
    """Rows (digit, piece, hashes, text, start, size): ``size`` windows from ``start`` on may
    be repeated.  ``hashes`` is null where the task has sent the same piece before."""

    def run(batches) -> Iterator:
        from hashlib import blake2b

        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("digit", pa.int64()), ("piece", pa.binary()), ("hashes", pa.binary()), ("text", pa.binary()),
                            ("start", pa.int64()), ("size", pa.int64())])
        known = set()
        for rows, count in _blocks(batches):
            h = _hashed(rows, count)
            owner = np.repeat(np.arange(len(rows)), count)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            hit = np.flatnonzero(seen.hits(shared.value, h, p))
            if not len(hit):
                continue
            out = [[] for _ in schema]
            for a, z in zip(*(x.tolist() for x in _stretches(hit, owner))):
                digit, _, text, start = rows[owner[a]]
                raw = h[a:z + 1].tobytes()
                piece = blake2b(raw, digest_size=16, key=digit.to_bytes(8, "little", signed=True)).digest()
                for col, v in zip(out, (digit, piece, None if piece in known else raw, text, start + int(at[a]), z - a + 1)):
                    col.append(v)
                if len(known) >= KNOWN:
                    known.clear()
                known.add(piece)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def _piece_windows(batches) -> Iterator:
    """(digit, piece, hashes, n) -> (digit, h, piece, at, n) for each window of each piece."""
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("digit", pa.int64()), ("h", pa.int64()), ("piece", pa.binary()), ("at", pa.int64()), ("n", pa.int64())])
    for b in batches:
        for digit, piece, raw, n in zip(*(b.column(k).to_pylist() for k in range(4))):
            h = np.frombuffer(raw, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(h), digit)), pa.array(h), pa.array([piece] * len(h), pa.binary()),
                pa.array(np.arange(len(h))), pa.array(np.full(len(h), n))], schema=schema)


def _placed(batches) -> Iterator:
    """(text, start, size, at) -> (text, starts and ends of covered bytes)."""
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("text", pa.binary()), ("spans", pa.binary())])
    for b in batches:
        spans = []
        for start, size, at in zip(*(b.column(n).to_pylist() for n in range(1, 4))):
            if at is None:
                spans.append(np.array([start, start + size - 1 + WINDOW], np.int64).tobytes())
            else:
                a = start + np.array(at, np.int64)
                spans.append(np.stack([a, a + WINDOW], 1).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.binary())], schema=schema)


def _large_spans(runs: DataFrame, p: seen.Plan) -> DataFrame:
    """What ``_compared`` gives, for digits of any number of runs: nothing is dealt out by
    digit alone, and each join has a written side of distinct keys, so the other can be split."""
    shared = seen.twice_seen(runs.mapInArrow(_send_windows(p), seen.MESSAGES), p)
    held = written(runs.mapInArrow(
        _pieces(p, shared), "digit long, piece binary, hashes binary, text binary, start long, size long"), "pieces")
    kinds = written(held.groupBy("digit", "piece").agg(F.max("hashes").alias("hashes"), F.count("*").alias("n")).select(
        "digit", "piece", "hashes", F.least("n", F.lit(2)).alias("n")), "piece-kinds")
    w = kinds.mapInArrow(_piece_windows, "digit long, h long, piece binary, at long, n long")
    again = written(w.groupBy("digit", "h").agg(F.sum("n").alias("n")).filter("n > 1").select("digit", "h"), "piece-windows")
    # a piece found twice is repeated in whole; of the others, the windows that others hold
    some = w.filter("n = 1").join(again, ["digit", "h"]).groupBy("piece").agg(F.collect_list("at").alias("at"))
    whole = kinds.filter("n > 1").select("piece", F.lit(None).cast("array<long>").alias("at"))
    marks = written(some.select("piece", "at").unionByName(whole), "piece-marks")
    return held.select("piece", "text", "start", "size").join(marks, "piece").select("text", "start", "size", "at").mapInArrow(
        _placed, "text binary, spans binary")


def dealt(runs: DataFrame, large: int = LARGE) -> tuple[DataFrame, DataFrame | None]:
    """The runs of digits up to ``large`` windows, and the other runs if there are any."""
    n = F.sum(F.length("bytes") - (WINDOW - 1))
    digit = written(runs.groupBy("digit").agg(n.alias("n")).filter(F.col("n") > large).select("digit"), "digits")
    if digit.isEmpty():
        return runs, None
    return runs.join(digit, "digit", "left_anti"), runs.join(digit, "digit", "left_semi")


def _removed(batches) -> Iterator:
    """(doc_id, text, spans, copies) -> counts and kept bytes."""
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept", pa.binary())])
    for b in batches:
        for k in range(0, b.num_rows, 256):
            some = b.slice(k, 256)
            out = [[], [], [], []]
            for text, spans, copies in zip(*(some.column(n).to_pylist() for n in range(1, 4))):
                raw = (text or "").encode("utf-8", "surrogatepass")
                n = len(raw)
                if copies and n >= WINDOW:
                    row = (n, n, 1, b"")
                elif spans:
                    s = np.concatenate([np.frombuffer(x, np.int64) for x in spans]).reshape(-1, 2)
                    step = np.bincount(s[:, 0], minlength=n + 1) - np.bincount(s[:, 1], minlength=n + 1)
                    gone = np.cumsum(step)[:n] > 0
                    row = (n, int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()),
                           np.frombuffer(raw, np.uint8)[~gone].tobytes())
                else:
                    row = (n, 0, 0, raw)
                for c, v in zip(out, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(c, f.type) for c, f in zip(out, [*schema][1:]))], schema=schema)


def find_runs(texts: DataFrame, p: seen.Plan) -> DataFrame:
    """``digit, bytes, text, start`` of the runs whose digit may occur again, written."""
    shared = seen.twice_seen(texts.mapInArrow(_send(p), seen.MESSAGES), p)
    return written(texts.mapInArrow(_runs(p, shared), "digit long, bytes binary, text binary, start long"), "runs")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", large: int = LARGE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes) per row of ``docs``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    d = d.withColumn("digest", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    p = seen.plan(d.sparkSession)
    texts = d.select("text", "digest")
    small, hot = dealt(find_runs(texts, p), large)
    spans = small.repartition("digit").sortWithinPartitions("digit").mapInArrow(_compared, "text binary, spans binary")
    if hot is not None:
        spans = spans.unionByName(_large_spans(hot, p))
    found = spans.groupBy("text").agg(F.collect_list("spans").alias("spans"))
    copies = d.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest", F.lit(True).alias("copies"))
    marks = found.withColumnRenamed("text", "digest").join(copies, "digest", "full")
    joined = d.join(marks, "digest", "left").select("doc_id", "text", "spans", "copies")
    return joined.mapInArrow(_removed, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]))


def repeat_report(docs: DataFrame, large: int = LARGE) -> DataFrame:
    return remove_repeats(docs, large=large).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
