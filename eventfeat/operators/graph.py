"""Weighted graph features (A1-A3) on edge DataFrames ``(src, dst, weight)``.

The graph never leaves the cluster: degrees are aggregates and PageRank is a
power iteration of join + aggregate steps with the lineage cut by a reliable
``checkpoint`` (into ``spark.checkpoint.dir``) every few iterations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfeat.session import cut_lineage
from eventfeat.sources.io import scratch_path

def edge_weights(df: DataFrame, src: str, dst: str, weight: str = "weight") -> DataFrame:
    """A1: directed edge list with weight = number of rows per (src, dst)."""
    return (df.filter(F.col(src).isNotNull() & F.col(dst).isNotNull())
            .groupBy(F.col(src).alias("src"), F.col(dst).alias("dst"))
            .agg(F.count(F.lit(1)).alias(weight)))


def weighted_degrees(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """A2: ``node, in_degree, out_degree`` (sum of edge weights; 0 when absent)."""
    outd = edges.groupBy(F.col("src").alias("node")).agg(F.sum(weight).cast("double").alias("out_degree"))
    ind = edges.groupBy(F.col("dst").alias("node")).agg(F.sum(weight).cast("double").alias("in_degree"))
    return (ind.join(outd, on="node", how="full_outer")
            .select("node", F.coalesce("in_degree", F.lit(0.0)).alias("in_degree"),
                    F.coalesce("out_degree", F.lit(0.0)).alias("out_degree")))


def salted_edges(edges: DataFrame, parts: int) -> DataFrame:
    """``src, salt, dst, p`` over ``parts`` partitions, and the number of salts of each
    source in ``salts``: a source's edges are cut into as many salts as it would fill
    partitions of mean size, so a hub with a third of all edges spreads over a third of
    them, and any other source has one."""
    per = edges.groupBy("src").agg(F.sum("w").alias("_ow"), F.count(F.lit(1)).alias("_n"))
    total = edges.count()
    salts = F.greatest(F.lit(1), F.ceil(F.col("_n") * parts / F.lit(max(total, 1)))).cast("int")
    return (edges.join(per.select("src", "_ow", salts.alias("salts")), on="src")
            .select("src", F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int").alias("salt"), "dst",
                    (F.col("w") / F.col("_ow")).alias("p"), "salts")
            .repartition(parts, "src", "salt"))


def pagerank(edges: DataFrame, weight: str = "weight", alpha: float = 0.85, max_iter: int = 100,
             tol: float = 1.0e-6, checkpoint_every: int = 5, fixed_iter: bool = False) -> DataFrame:
    """A3: weighted PageRank with uniform teleport and dangling mass spread
    uniformly; starts from 1/N and stops when the L1 change < N * tol (the usual
    graph-library convention).  ``fixed_iter`` runs exactly ``max_iter`` steps.

    Edges stay where they are for all steps, cut by (source, salt); each step sends every
    source's rank once per salt (rows of the size of the nodes) and the contributions,
    summed per task, by target.  So neither a source nor a target with a large share of all
    edges meets in one task.  Returns ``node, pagerank``.  Raises if not converged within
    ``max_iter``."""
    spark = edges.sparkSession
    # the edge list is the only input; written once so the upstream plan (e.g. a join over
    # the fact table) runs a single time, in files of the cluster's advisory size
    e = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst", F.col(weight).cast("double").alias("w"))
    path = scratch_path(spark, "edges")
    e.hint("rebalance").write.parquet(path)
    e = spark.read.schema(e.schema).parquet(path)
    parts = max(1, e.rdd.getNumPartitions())  # as wide as the written edge list
    en = salted_edges(e, parts).cache()
    outs = en.groupBy("src").agg(F.max("salts").alias("salts"))
    nodes = (e.select(F.col("src").alias("node")).union(e.select(F.col("dst").alias("node")))
             .repartition(parts, "node").dropDuplicates(["node"])
             .join(outs.select(F.col("src").alias("node"), "salts"), "node", "left")
             .select("node", F.col("salts").isNull().alias("dangling"), F.coalesce("salts", F.lit(0)).alias("salts")).cache())
    st = nodes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("dangling").cast("long")).alias("nd")).first()
    n = int(st["n"])
    if n == 0:
        return spark.createDataFrame([], "node string, pagerank double")
    dm = float(st["nd"] or 0) / n          # rank mass on dangling nodes
    ranks = nodes.withColumn("r", F.lit(1.0 / n))
    prev_cached = None
    for it in range(1, max_iter + 1):
        sent = ranks.filter("salts > 0").select(F.col("node").alias("src"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "r")
        contrib = (en.join(sent, on=["src", "salt"])
                   .select(F.col("dst").alias("node"), (F.col("r") * F.col("p")).alias("_c"))
                   .groupBy("node").agg(F.sum("_c").alias("_in")))  # summed before it is shuffled
        new = (ranks.join(contrib, on="node", how="left")
               .select("node", "dangling", "salts", F.col("r").alias("_old"),
                       (F.lit(alpha) * (F.coalesce(F.col("_in"), F.lit(0.0)) + F.lit(dm / n))
                        + F.lit((1 - alpha) / n)).alias("r")))
        new = cut_lineage(new) if it % checkpoint_every == 0 else new.cache()
        # one pass gives the L1 change and the next dangling mass
        st = new.agg(F.sum(F.abs(F.col("r") - F.col("_old"))).alias("err"),
                     F.sum(F.when(F.col("dangling"), F.col("r")).otherwise(F.lit(0.0))).alias("dm")).first()
        if prev_cached is not None:
            prev_cached.unpersist()
        prev_cached = new if new.is_cached else None
        err, dm = float(st["err"]), float(st["dm"])
        ranks = new.select("node", "dangling", "salts", "r")
        if (not fixed_iter and err < n * tol) or (fixed_iter and it == max_iter):
            # the result is tiny: cut its lineage once more and release every
            # intermediate cache so later plans are not matched against them
            out = cut_lineage(ranks.select("node", F.col("r").alias("pagerank")))
            for d in (prev_cached, en, nodes):
                if d is not None:
                    d.unpersist()
            return out
    raise RuntimeError(f"pagerank did not converge in {max_iter} iterations")


def node_metrics(edges: DataFrame, weight: str = "weight", **pr_kwargs) -> DataFrame:
    """``node, pagerank, in_degree, out_degree`` ready for role joins."""
    edges = cut_lineage(edges)  # used by both: the plan above it runs once
    return pagerank(edges, weight, **pr_kwargs).join(weighted_degrees(edges, weight), on="node", how="left")
