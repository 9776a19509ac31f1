"""Which hashes occur at least twice in a corpus, with two Bloom filters.

Tasks send their 64-bit hashes to the owner of the hash's segment (32 bits of each; a
hash that a chunk holds more than once is sent twice, never more).  The owner streams
them through a *once-seen* filter; what meets its own bits there enters the segment's
part of the *twice-seen* filter.  No repeat is ever missed; a false hit is possible and
only costs its user an exact look.

The twice-seen filter has ``filter_bits`` bits whatever the input (its parts have a fixed
size), so it may go to the driver and to every task.  The once-seen filters stay in
their owners.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from eventfeat.llm.common import shuffle_parts

FILTER_BITS = 1 << 26   # twice-seen filter: 8 MB in all
ONCE_BITS = 1 << 23     # once-seen filter of one segment: 1 MB
CHUNK = 1 << 20         # hashes that a task holds before it sends them
MESSAGES = "seg int, h binary"


@dataclass(frozen=True)
class Plan:
    segments: int
    part_bits: int


def plan(spark: SparkSession, filter_bits: int = FILTER_BITS) -> Plan:
    """Segments grow with the cluster's shuffle parallelism."""
    segments = 1 << max(6, (4 * shuffle_parts(spark) - 1).bit_length())
    return Plan(segments, max(1 << 10, filter_bits // segments))


def _split(h, p: Plan):
    """Segment and 32 further bits of each hash."""
    import numpy as np

    return (h % np.uint64(p.segments)).astype(np.int32), (h >> np.uint64(32)).astype(np.uint32)


def _bits(r, n: int):
    """Two bit numbers within a filter of ``n`` bits (a power of two) for the 32 bits ``r``."""
    import numpy as np

    x = r.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    mask = np.uint64(n - 1)
    return (x >> np.uint64(36)) & mask, (x >> np.uint64(8)) & mask


def messages(hashes: list, p: Plan):
    """One record batch (segment, bits of its hashes) for a chunk of hash arrays."""
    import numpy as np
    import pyarrow as pa

    h, n = np.unique(np.concatenate(hashes), return_counts=True)
    h = np.concatenate([h, h[n > 1]])
    seg, rest = _split(h, p)
    order = np.argsort(seg, kind="stable")
    seg, rest = seg[order], rest[order]
    ids, at = np.unique(seg, return_index=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int32()), pa.array([x.tobytes() for x in np.split(rest, at[1:])], pa.binary())],
        schema=pa.schema([("seg", pa.int32()), ("h", pa.binary())]))


def send(arrays: Iterator, p: Plan) -> Iterator:
    """Record batches for a stream of hash arrays, chunk by chunk."""
    held, n = [], 0
    for a in arrays:
        if len(a):
            held.append(a)
            n += len(a)
        if n >= CHUNK:
            yield messages(held, p)
            held, n = [], 0
    if held:
        yield messages(held, p)


def _owners(p: Plan):
    """Rows (segment, hashes) sorted by segment -> (segment, packed twice-seen part)."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("seg", pa.int32()), ("bits", pa.binary())])
        seg, once, twice = None, None, None

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([seg], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())], schema=schema)

        for b in batches:
            for s, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if s != seg:
                    if seg is not None and twice.any():
                        yield out()
                    seg, once, twice = s, np.zeros(ONCE_BITS, bool), np.zeros(p.part_bits, bool)
                u, n = np.unique(np.frombuffer(raw, np.uint32), return_counts=True)
                i, j = _bits(u, ONCE_BITS)
                again = u[(once[i] & once[j]) | (n > 1)]
                once[i] = once[j] = True
                i, j = _bits(again, p.part_bits)
                twice[i] = twice[j] = True
        if seg is not None and twice.any():
            yield out()

    return run


def twice_seen(sent: DataFrame, p: Plan):
    """Broadcast variable with the twice-seen filter of the messages ``sent``."""
    import numpy as np

    spark = sent.sparkSession
    parts = sent.repartition(min(p.segments, shuffle_parts(spark)), "seg").sortWithinPartitions("seg").mapInArrow(
        _owners(p), "seg int, bits binary")
    size = p.part_bits // 8
    bits = np.zeros(p.segments * size, np.uint8)
    for seg, raw in parts.collect():  # segments * part_bits bits at most, in all
        bits[seg * size:(seg + 1) * size] = np.frombuffer(bytes(raw), np.uint8)
    return spark.sparkContext.broadcast(bits)


def hits(bits, h, p: Plan):
    """Which of the hashes ``h`` may have been seen twice."""
    import numpy as np

    seg, rest = _split(h, p)
    base = seg.astype(np.int64) * (p.part_bits // 8)
    found = np.ones(len(h), bool)
    for at in _bits(rest, p.part_bits):
        at = at.astype(np.int64)
        found &= (bits[base + (at >> 3)] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return found
