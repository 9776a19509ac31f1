"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfeat.session import ensure_checkpoint_dir

#: ASCII white space, the separator of words everywhere in this subpackage
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also fold letters outside ASCII)."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Array of the words of a text (maximal runs of non-space characters); a null
    text has none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), f"{SPACE_CLASS}+"), "")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared checkpoint folder and read it
    back: lineage is cut, and a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    """The cluster's shuffle parallelism, which its owner sizes with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
