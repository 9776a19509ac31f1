"""N-gram Jaccard self-join: rare-first prefix filtering, each pair verified once.

Texts are sets of 64-bit hashes of five-word shingles.  Two sets link when
``100 * |x & y| >= 75 * |x | y|``.

1. The shingles whose hash is even go through the twice-seen filter (module ``seen``).  In
   the order *known to be unique* < *rarer* < *more frequent*, a set whose first
   ``n - ceil(0.75 n) + 1`` shingles (its prefix) are all known to be unique can link with
   nothing: most documents end here and send none of their shingles.
2. Equal sets collapse into one class.  The remaining classes' shingles are counted
   exactly; those of one class only are dropped, and the rest of each prefix is kept with
   its position: rarest shingles first, ties by hash.
3. Candidates share a prefix shingle and pass the length and position filters; the suffix
   filter bounds the overlap from above by the Hamming distance of two bit sketches, which
   is never above that of the sets.  First every member of a
   prefix shingle's group is compared with the group's smallest id only, which yields the
   components of copies without their pairs; then the pairs of the group that are still in
   different components, whole, each once, by exact overlap.  Pairs already in one
   component need no verification, so no link between components is missed.

Defined results: a null or empty text, or one of white space, is empty, has no shingles
and links with nothing (its component is its id); fewer than five words are one shingle
of the whole sequence; repeated rows are equal sets and link; a null id is below all
others only for itself: its row has a null component and never names another's; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventfeat.llm import seen
from eventfeat.llm.common import written
from eventfeat.llm.components import components

WORDS_PER_SHINGLE = 5
PERCENT = 75
SKETCH_BITS = 1024  # of the suffix filter
FILTER_BITS = 1 << 27


def shingles(text: str | None, k: int = WORDS_PER_SHINGLE):
    """Sorted distinct 64-bit hashes of the word k-grams of a text."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and space only
    if not w:
        return np.empty(0, np.uint64)
    a = np.fromiter(map(xxh3_64_intdigest, w), np.uint64, len(w))
    m = min(k, len(w))
    n = len(w) - m + 1
    h = np.full(n, m, np.uint64)  # shorter sequences hash apart from k-grams
    for i in range(m):
        h = h * np.uint64(0x9E3779B97F4A7C15) + a[i:i + n]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def _sketch(h):
    """Parity of the number of shingles in each of SKETCH_BITS hash ranges, as 64-bit words."""
    import numpy as np

    odd = np.bincount((h >> np.uint64(64 - (SKETCH_BITS.bit_length() - 1))).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def prefix_length(n, percent: int = PERCENT):
    """Shingles of which two linked sets must share one: n - ceil(t n) + 1."""
    return n - (n * percent + 99) // 100 + 1


def _send(k: int, p: seen.Plan):
    def run(batches) -> Iterator:
        import numpy as np

        def arrays():
            known = set()  # equal sets of this task are one
            for b in batches:
                for text in b.column(0).to_pylist():
                    h = shingles(text, k)
                    key = hash(h.tobytes())
                    if key not in known:
                        known.add(key)
                        # half of the hash space is enough to know a quarter as unique
                        yield h[(h >> np.uint64(20)) & np.uint64(1) == 0]

        return seen.send(arrays(), p)

    return run


def _sets(k: int, percent: int, p: seen.Plan, shared):
    """Per document: size, digest, and the shingles that may be shared (null if its prefix
    is known to be unique)."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("hs", pa.list_(pa.int64())),
                            ("bits", pa.list_(pa.int64()))])
        for b in batches:
            for at in range(0, b.num_rows, 512):
                some = b.slice(at, 512)
                hs = [shingles(t, k) for t in some.column(1).to_pylist()]
                n = np.array([len(h) for h in hs])
                all_h = np.concatenate(hs) if hs else np.empty(0, np.uint64)
                owner = np.repeat(np.arange(len(hs)), n)
                shared_h = np.ones(len(all_h), bool)
                asked = np.flatnonzero((all_h >> np.uint64(20)) & np.uint64(1) == 0)
                shared_h[asked] = seen.hits(shared.value, all_h[asked], p)
                unique = n - np.bincount(owner, shared_h, len(hs)).astype(np.int64)
                live = (n > 0) & (unique < prefix_length(n, percent))
                keep = shared_h & live[owner]
                cuts = np.r_[0, np.cumsum(np.bincount(owner[keep], minlength=len(hs)))].astype(np.int32)
                kept = all_h[keep]
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(kept.view(np.int64)),
                                                 mask=pa.array(~live))
                bits = [_sketch(kept[a:z]) if ok else None for a, z, ok in zip(cuts[:-1], cuts[1:], live)]
                yield pa.RecordBatch.from_arrays([
                    some.column(0), pa.array(n, pa.int64()),
                    pa.array([xxh3_128_digest(h.tobytes()) for h in hs], pa.binary()), lists,
                    pa.array(bits, pa.list_(pa.int64()))], schema=schema)

    return run


def needed(n1: Column, n2: Column, percent: int = PERCENT) -> Column:
    """Smallest overlap with which sets of these sizes link."""
    return F.ceil(F.lit(percent) * (n1 + n2) / F.lit(100 + percent))


def _may_link(x: str, y: str, percent: int) -> Column:
    """Length and position filters of two prefix entries of one shingle."""
    n1, n2 = F.col(f"{x}.n"), F.col(f"{y}.n")
    left = F.least(n1 - F.col(f"{x}.pos"), n2 - F.col(f"{y}.pos"))  # shingles from here on
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (left >= needed(n1, n2, percent))


def _sketches_may_link(x: str, y: str, percent: int) -> Column:
    """Suffix filter: sets that differ in d shingles have sketches that differ in d bits at
    most, so the overlap is at most (sizes - differing bits) / 2."""
    apart = F.aggregate(F.zip_with(f"{x}.bits", f"{y}.bits", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda a, b: a + b)
    return F.col(f"{x}.m") + F.col(f"{y}.m") - apart >= 2 * needed(F.col(f"{x}.n"), F.col(f"{y}.n"), percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the candidate pairs (a, b), by exact overlap."""
    one = lambda c: sets.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("hs").alias(f"hs_{c}"))
    both = pairs.join(one("a"), "a").join(one("b"), "b")
    same = F.size(F.array_intersect("hs_a", "hs_b"))
    return both.filter(100 * same >= percent * (F.col("n_a") + F.col("n_b") - same)).select("a", "b")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS_PER_SHINGLE,
          percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    p = seen.plan(spark, FILTER_BITS)
    shared = seen.twice_seen(d.select("text").mapInArrow(_send(k, p), seen.MESSAGES), p)
    rows = written(d.mapInArrow(_sets(k, percent, p, shared), "id long, n long, digest binary, hs array<long>, bits array<long>"), "sets")

    classes = rows.filter("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("class"))
    sets = written(rows.filter("hs IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("hs").alias("hs"), F.first("bits").alias("bits")).drop("digest"), "classes")

    tokens = sets.select("id", "n", F.explode("hs").alias("h"))
    counts = tokens.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    common = tokens.join(counts, "h").select("id", "n", F.struct("df", "h").alias("t"))
    # rarest first; the shingles of one class only come before all of these
    ordered = common.groupBy("id", "n").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    prefix_n = F.expr(f"n - (n * {percent} + 99) DIV 100 + 1")
    unique = F.col("n") - F.size("ts")
    prefix = ordered.filter(unique < prefix_n).select(
        "id", "n", F.posexplode(F.slice("ts", F.lit(1), (prefix_n - unique).cast("int"))).alias("at", "t"), unique.alias("unique")
    ).select("id", "n", F.col("t.h").alias("h"), (F.col("unique") + F.col("at")).alias("pos"))
    entries = written(prefix, "prefixes")

    # first look: every member of a group with the group's smallest id
    first = entries.groupBy("h").agg(F.min(F.struct("id", "n", "pos")).alias("x"))
    star = entries.select("h", F.struct("id", "n", "pos").alias("y")).join(first, "h").filter(
        (F.col("x.id") < F.col("y.id")) & _may_link("x", "y", percent)).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    star = written(star, "star")
    found = written(_verified(star, sets, percent), "star-links")
    labels = components(found)

    # second look: whatever still shares a prefix shingle across components.  An entry
    # stays if even the smallest partner of its group could pass the position filter, and
    # two components of a group meet if their best entries could
    smallest = entries.groupBy("h").agg(F.min("n").alias("low"))
    open_ = entries.join(smallest, "h").filter(F.col("n") - F.col("pos") >= needed(
        F.col("n"), F.greatest(F.ceil(F.col("n") * percent / 100), F.col("low")), percent)).drop("low")
    open_ = written(open_, "viable")

    def labelled(labels):
        return open_.join(labels.select(F.col("node").alias("id"), "component"), "id", "left").withColumn(
            "component", F.coalesce("component", "id"))

    # between the looks: all others of a group with one member of its largest component, so
    # that large components which belong together meet in few pairs
    now = written(labelled(labels), "named")
    one = now.groupBy("h", "component").agg(F.count("*").alias("members"), F.max_by(
        F.struct("id", "n", "pos"), F.struct(F.col("n") - F.col("pos"), -F.col("id"))).alias("x"))
    top = one.groupBy("h").agg(F.max_by(F.struct("component", "x"), F.struct("members", -F.col("component"))).alias("t")).select(
        "h", F.col("t.component").alias("top"), F.col("t.x").alias("x"))
    again = now.select("h", "component", F.struct("id", "n", "pos").alias("y")).join(top, "h").filter(
        (F.col("component") != F.col("top")) & _may_link("x", "y", percent)).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    again = written(again.join(star, ["a", "b"], "left_anti"), "again")
    found = written(found.unionByName(_verified(again, sets, percent)), "links-so-far")
    star = star.unionByName(again)
    labels = components(found)

    named = labelled(labels)
    named = written(named, "open")
    parts = named.groupBy("h", "component").agg(F.count("*").alias("members"), F.min("n").alias("low"),
                                                F.max(F.col("n") - F.col("pos")).alias("rest"))
    mixed = parts.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1").select("h")
    parts = written(parts.join(mixed, "h"), "mixed")

    def best(n1, r1, n2, r2):
        return F.least(F.col(r1), F.col(r2)) >= needed(F.col(n1), F.col(n2), percent)

    # each pair of components once, the one with fewer members first
    rank = lambda x: F.struct(f"{x}.members", f"{x}.component")
    q = parts.alias("p").join(parts.alias("q"), (F.col("p.h") == F.col("q.h")) & (rank("p") < rank("q"))
                              & best("p.low", "p.rest", "q.low", "q.rest")).select(
        F.col("p.h").alias("h"), F.col("p.component").alias("c1"), F.col("q.component").alias("c2"),
        F.col("q.low").alias("low"), F.col("q.rest").alias("rest"))
    q = written(q, "meeting")
    sketches = sets.select("id", F.size("hs").alias("m"), "bits")
    entry = F.struct("id", "n", "pos", "m", "bits")
    low, rest = F.col("low"), F.col("rest")
    xs = named.withColumnRenamed("component", "c1").join(q, ["h", "c1"]).filter(
        F.least(F.col("n") - F.col("pos"), rest) >= needed(F.col("n"), low, percent)).select("h", "c2", "id", "n", "pos")
    ys = named.withColumnRenamed("component", "c2").join(q.select("h", "c2").distinct(), ["h", "c2"]).select("h", "c2", "id", "n", "pos")
    xs, ys = (d.join(sketches, "id").select("h", "c2", entry.alias(s)) for d, s in ((xs, "x"), (ys, "y")))
    cross = xs.join(ys, ["h", "c2"]).filter(_may_link("x", "y", percent) & _sketches_may_link("x", "y", percent)).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    cross = cross.join(star, ["a", "b"], "left_anti")
    more = _verified(cross, sets, percent)
    final = components(found.unionByName(more))

    of_class = classes.join(final.select(F.col("node").alias("class"), "component"), "class", "left").select(
        "digest", F.coalesce("component", "class").alias("component"))
    return rows.join(of_class, "digest", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS_PER_SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (all their columns) with the smallest id of each component.
    Rows that repeat an id and a text are one document; rows of one id and several texts are
    parts of one document, which stay or go together; rows with a null id stay."""
    found = written(links(docs, id_col, text_col, k, percent), "components")
    gone = written(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct(), "gone")
    again = written(found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).count().filter("count > 1").select("__id"), "again")
    at = F.col(id_col).cast("long") == F.col("__id")
    left = docs.join(gone, at, "left_anti")
    return left.join(again, at, "left_anti").unionByName(left.join(again, at, "left_semi").dropDuplicates([id_col, text_col]))
