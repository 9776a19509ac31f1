"""Parquet/CSV scans, literal tables, partitioned and ordered sinks, committed stage
versions, model persistence and an append-only metric log (S1-S9, O1).

Paths are plain URIs (local, HDFS, object store).  Nothing is collected: folds
are discovered with a distinct over the partition column, not by listing folders
on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventfeat.session import ensure_checkpoint_dir

# --- fixed values: horizon -> path suffix of stage folders
HORIZON_SUFFIX: dict[str, str] = {"3m": "_3m", "6m": "_6m", "1y": "_1y", "all": ""}


def stage_path(root: str, stage: str, horizon: str = "all") -> str:
    if horizon not in HORIZON_SUFFIX:
        raise ValueError(f"horizon must be one of {sorted(HORIZON_SUFFIX)}, got {horizon!r}")
    return f"{root.rstrip('/')}{HORIZON_SUFFIX[horizon]}/{stage}"


def read_stage(spark: SparkSession, root: str, stage: str, horizon: str = "all") -> DataFrame:
    """Parquet scan of a horizon-suffixed stage folder (lazy; filters and
    projections applied later are pushed into the scan)."""
    return spark.read.parquet(current_version(spark, stage_path(root, stage, horizon)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header; an explicit schema avoids the inference pass."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """S3: small in-line table (calendars, mapping tables)."""
    return spark.createDataFrame(list(rows), schema)


def read_partition(spark: SparkSession, path: str, **parts) -> DataFrame:
    """Scan a hive-partitioned folder, pruning partitions by equality filters
    (``read_partition(spark, p, split="train")``) instead of hard-coding sub-paths."""
    df = spark.read.parquet(current_version(spark, path))
    for k, v in parts.items():
        df = df.filter(F.col(k) == F.lit(v))
    return df


def list_folds(df: DataFrame, col: str = "fold") -> DataFrame:
    """Fold discovery from the data (partition values), sorted."""
    return df.select(col).distinct().orderBy(col)


def write_stage(df: DataFrame, path: str, n: int | None = None, keys: Sequence[str] = (),
                partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Parquet sink; with ``n`` and ``keys`` rows are hash-repartitioned into
    ``n`` tasks by the keys first (bounded file count, co-located keys)."""
    if n and keys:
        df = df.repartition(n, *keys)
    elif n:
        df = df.repartition(n)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_splits(parts: Mapping[str, DataFrame], path: str, by: str = "split", mode: str = "overwrite") -> str:
    """Union of tagged parts written partitioned by the tag (``split=train/``...)."""
    from eventfeat.operators.split import tagged_union

    tagged_union(parts, by).write.mode(mode).partitionBy(by).parquet(path)
    return path


# ------------------------------------------------------------------ committed versions

_COMMITS = "_commits"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of a folder's entries; none if it is missing."""
    fs, p = _fs(spark, path)
    return [(f.getPath().getName(), f.getModificationTime()) for f in fs.listStatus(p)] if fs.exists(p) else []


def commits(spark: SparkSession, path: str) -> list[str]:
    """Version folders of a stage in order of their commits; an entry of the commit log is
    an empty file ``<number>.<version>``."""
    entries = [n.split(".", 1) for n, _ in _children(spark, f"{path}/{_COMMITS}") if not n.startswith("_")]
    return [v for _, v in sorted((int(k), v) for k, v in entries)]


def current_version(spark: SparkSession, path: str) -> str:
    """The folder that readers of a stage take: its last committed version, or the folder
    itself where a stage has none.  What a failed or running write has left is never read."""
    done = commits(spark, path)
    return f"{path}/{done[-1]}" if done else path


def write_version(df: DataFrame, path: str, n: int | None = None, keys: Sequence[str] = (), partition_by: Sequence[str] = (),
                  keep: int = 2) -> str:
    """S5-S7 as a commit: the rows go to a new version folder, and only when all are written
    does an entry of the commit log name it.  Creating the entry is one file-system call
    that fails if the number is taken, so of two writers one is told.  The last ``keep``
    versions stay, older ones are removed.  Returns the version's folder."""
    spark, done = df.sparkSession, commits(df.sparkSession, path)
    version = f"v{len(done):06d}-{uuid.uuid4().hex[:12]}"
    write_stage(df, f"{path}/{version}", n, keys, partition_by, mode="errorifexists")
    # a number whose writer died between the two steps is skipped
    number = max((int(n.lstrip("_").split(".", 1)[0]) for n, _ in _children(spark, f"{path}/{_COMMITS}")), default=-1) + 1
    fs, entry = _fs(spark, f"{path}/{_COMMITS}/_{number:09d}")
    fs.create(entry, False).close()  # takes the number, or raises
    fs.rename(entry, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_COMMITS}/{number:09d}.{version}"))
    remove_versions(spark, path, keep)
    return f"{path}/{version}"


def remove_versions(spark: SparkSession, path: str, keep: int = 2, abandoned_s: float = 86_400) -> list[str]:
    """Remove the committed versions before the last ``keep``, and folders that no commit
    names and nothing has changed for ``abandoned_s`` seconds (failed writes).  Returns the
    removed names."""
    import time

    done = commits(spark, path)
    old, named = set(done[:-keep] if keep else done), set(done)
    limit = (time.time() - abandoned_s) * 1000
    gone = [n for n, t in _children(spark, path) if n in old or (n.startswith("v") and n not in named and t < limit)]
    for name in gone:
        if name in old:  # the log entry first: no reader resolves to a folder that goes
            for e, _ in _children(spark, f"{path}/{_COMMITS}"):
                if e.endswith(f".{name}"):
                    fs, p = _fs(spark, f"{path}/{_COMMITS}/{e}")
                    fs.delete(p, False)
        fs, p = _fs(spark, f"{path}/{name}")
        fs.delete(p, True)
    return gone


# ------------------------------------------------------------------ O1 ordered output

def write_ordered(df: DataFrame, path: str, by: Sequence[str | Column], partitions: int | None = None) -> str:
    """O1: parquet in global order of ``by``: range-partitioned (sampled bounds), sorted
    inside each file, files in the order of their names.  No task sorts all rows."""
    r = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    r.sortWithinPartitions(*by).write.option("maxRecordsPerFile", 0).parquet(path)
    return path


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """O1: rows of ``write_ordered`` with their place in the whole order, from 0: the rows
    of all files before (one count per file) plus the row's index in its file."""
    df = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    w = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    return df.join(starts, "_file").withColumn(position, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")


# ------------------------------------------------------------------ scratch

def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local on
    a cluster: ``spark.checkpoint.dir`` is the cluster's shared folder), named by the
    application so that ``remove_scratch`` finds it."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/eventfeat-{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, application_id: str | None = None) -> list[str]:
    """Remove the scratch folders of an application (this one by default), when its results
    are written and no DataFrame that reads them is used any more.  Returns their names."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    mine = f"eventfeat-{application_id or spark.sparkContext.applicationId}-"
    gone = [n for n, _ in _children(spark, base) if n.startswith(mine)]
    for name in gone:
        fs, p = _fs(spark, f"{base}/{name}")
        fs.delete(p, True)
    return gone


def save_model(model, path: str) -> str:
    """Persist a fitted Pipeline/Model (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Reload a PipelineModel, or a single model when saved standalone, by the class
    that its metadata names."""
    from pyspark.ml.util import DefaultParamsReader

    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())


METRIC_SCHEMA = "run_id string, fold int, step int, name string, value double"


def log_metrics(df: DataFrame, path: str, run_id: str, fold_col: str = "fold", step_col: str = "step",
                metric_cols: Sequence[str] | None = None) -> DataFrame:
    """Append wide metric rows to a long-format log ``run_id, fold, step, name,
    value`` (parquet, append mode) and return the rows written."""
    metric_cols = list(metric_cols or [c for c in df.columns if c not in (fold_col, step_col)])
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in metric_cols)
    long = df.selectExpr(f"cast({fold_col} as int) as fold", f"cast({step_col} as int) as step",
                         f"stack({len(metric_cols)}, {stack}) as (name, value)").select(
        F.lit(run_id).alias("run_id"), "fold", "step", "name", "value")
    long.write.mode("append").parquet(path)
    return long


def metric_history(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Read the metric log back (optionally one metric)."""
    df = spark.read.schema(METRIC_SCHEMA).parquet(path)
    return df.filter(F.col("name") == name) if name else df


def latest_metrics(log: DataFrame) -> DataFrame:
    """Last logged value per (run, fold, name) -- ``max_by`` over step."""
    return log.groupBy("run_id", "fold", "name").agg(F.max("step").alias("step"), F.max_by("value", "step").alias("value"))
