"""Line dedup with two Bloom filters.

1. Each task sends the hashes of its line keys (one per document) to their owners, which
   fill the once-seen and twice-seen filters (see ``seen``).
2. The twice-seen filter, of fixed size, goes to every task.  Only lines that hit it are
   shuffled, as 128-bit digests of the whole key, and are confirmed exactly: documents per
   key, largest id.
3. Documents that lose lines are joined with their keys to drop and rewritten.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z
lower-cased.  A key of at least ``min_chars`` code points found in at least ``min_docs``
documents stays only in the largest id that holds it (there, every such line stays).

Defined results: a null or empty text is one empty line; a row is a document, so repeated
rows count one by one and, sharing the largest id, keep their lines alike; a null id is
below all others; extra columns are passed on; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventfeat.llm import seen
from eventfeat.llm.common import written

SPACE = b" \t\n\x0b\x0c\r"


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """Key of each line, None where the line is too short to be considered."""
    out: list[bytes | None] = []
    for line in (text or "").split("\n"):
        if len(line) < min_chars:
            out.append(None)
            continue
        key = line.encode("utf-8", "surrogatepass").strip(SPACE).lower()
        out.append(key if len(key) >= min_chars and len(key.decode("utf-8", "surrogatepass")) >= min_chars else None)
    return out


def _spread(min_chars: int, p: seen.Plan):
    """Task of step 1: messages with the key hashes of its documents."""

    def run(batches) -> Iterator:
        import numpy as np
        from xxhash import xxh3_64_intdigest

        def arrays():
            for b in batches:
                for text in b.column(0).to_pylist():
                    yield np.array([*{xxh3_64_intdigest(k) for k in line_keys(text, min_chars) if k is not None}], np.uint64)

        return seen.send(arrays(), p)

    return run


def _suspects(min_chars: int, p: seen.Plan, shared):
    """Task of step 2: (digest, row, id) of each key of a document that hits the filter."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest, xxh3_128_digest

        schema = pa.schema([("k", pa.binary()), ("row", pa.int64()), ("id", pa.int64())])
        for b in batches:
            hashes, keys, rows, ids = [], [], [], []
            for text, row, i in zip(*(b.column(n).to_pylist() for n in range(3))):
                found = {k for k in line_keys(text, min_chars) if k is not None}
                keys.extend(found)
                hashes.extend(map(xxh3_64_intdigest, found))
                rows.extend([row] * len(found))
                ids.extend([i] * len(found))
            if not keys:
                continue
            take = np.flatnonzero(seen.hits(shared.value, np.array(hashes, np.uint64), p)).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array([xxh3_128_digest(keys[n]) for n in take], pa.binary()),
                pa.array([rows[n] for n in take], pa.int64()), pa.array([ids[n] for n in take], pa.int64())], schema=schema)

    return run


def _rewrite(min_chars: int, schema: T.StructType, text_at: int):
    """Task of step 3: the text without the dropped lines; last two columns are
    (dropped keys) -> replaced by (n_lines, n_dropped)."""

    def run(batches) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for b in batches:
            names = b.schema.names
            texts, drops = b.column(text_at).to_pylist(), b.column(len(names) - 1).to_pylist()
            new, n_lines, n_dropped = [], [], []
            for text, drop in zip(texts, drops):
                if not drop:
                    new.append(text)
                    n_lines.append((text or "").count("\n") + 1)
                    n_dropped.append(0)
                    continue
                gone = set(drop)
                lines = text.split("\n")
                keep = [x for x, k in zip(lines, line_keys(text, min_chars)) if k is None or xxh3_128_digest(k) not in gone]
                new.append("\n".join(keep))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(keep))
            cols = [b.column(n) for n in range(len(names) - 1)]
            cols[text_at] = pa.array(new, b.schema.field(text_at).type)
            fields = [b.schema.field(n) for n in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                schema=pa.schema([*fields, pa.field("__n_lines", pa.int64()), pa.field("__n_dropped", pa.int64())]))

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5) -> DataFrame:
    """``docs`` with its text rewritten, plus ``__n_lines`` and ``__n_dropped``."""
    p = seen.plan(docs.sparkSession)
    # a row is known by its id and the hash of id and text: equal rows lose the same lines
    row = F.xxhash64(F.col(id_col), F.col(text_col))

    shared = seen.twice_seen(docs.select(F.col(text_col)).mapInArrow(_spread(min_chars, p), seen.MESSAGES), p)
    suspects = docs.select(F.col(text_col), row.alias("row"), F.col(id_col).cast("long").alias("id")).mapInArrow(
        _suspects(min_chars, p, shared), "k binary, row long, id long")
    suspects = written(suspects, "line-suspects")
    drop = suspects.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("keep")).filter(F.col("n") >= min_docs)
    # written: the join below then deals both sides out anew and a line that very many
    # documents share can be split
    drop = written(drop.select("k", "keep"), "line-drop")
    lost = suspects.join(drop, "k").filter(~F.col("id").eqNullSafe(F.col("keep"))).groupBy(
        F.col("row").alias("__lost"), F.col("id").alias("__of")).agg(F.collect_set("k").alias("__drop"))
    joined = docs.withColumn("__row", row).join(
        lost, (F.col("__row") == F.col("__lost")) & F.col(id_col).cast("long").eqNullSafe(F.col("__of")), "left").select(*docs.columns, "__drop")
    out = T.StructType([*docs.schema.fields, T.StructField("__n_lines", T.LongType()), T.StructField("__n_dropped", T.LongType())])
    return joined.mapInArrow(_rewrite(min_chars, out, docs.columns.index(text_col)), out)


def line_report(docs: DataFrame, **params) -> DataFrame:
    """Per document: lines before, lines dropped, digest of the kept text."""
    d = dedup_lines(docs.select("doc_id", "text"), **params)
    return d.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def oracle_sql(min_chars: int = 40, min_docs: int = 5) -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
c AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= {min_chars} GROUP BY key HAVING count(DISTINCT rid) >= {min_docs}),
j AS (SELECT k.*, c.key IS NOT NULL AND doc_id IS DISTINCT FROM keep AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id"""
