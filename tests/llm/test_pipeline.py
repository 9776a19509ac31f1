"""The pipeline against a plain-Python version of its stages."""

import random
from collections import Counter

from helpers import SCHEMA, jaccard_components, line_dedup, prose

import corpus_pipeline as P
from eventfeat.llm import decontam, packing, quality


def _corpus():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(3, 8))) for _ in range(900)]
    line = "The very same notice of rights and terms that is on every page here."
    test = [(n, prose(rng, 30, vocab=[f"q{n}z{k}" for k in range(50)])) for n in range(4)]
    docs = [(n, prose(rng, rng.randint(60, 200), vocab) + (f"\n{line}" if n % 3 == 0 else "")) for n in range(60)]
    docs += [(100 + n, docs[n][1]) for n in range(0, 20, 4)]
    docs += [(200 + n, docs[n][1].replace(" the ", " a ", 1)) for n in range(1, 20, 5)]
    docs += [(300 + n, docs[30 + n][1] + " " + t + " " + docs[31 + n][1]) for n, t in test]
    docs += [(400, None), (401, ""), (402, "go " * 90), (403, "a b c")]
    return docs, test


def test_pipeline_against_plain_python(spark, tmp_path):
    docs, test = _corpus()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(test, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = Counter((r.doc_id, r.doc_tokens) for r in P.run(spark, str(tmp_path)).collect() if r.start == 0)

    kept = {r.doc_id for r in quality.quality_report(spark.createDataFrame(docs, "doc_id long, text string")).filter("kept").collect()}
    left = [(i, t) for i, t in docs if i in kept]
    left = [(i, t) for i, _, _, t in line_dedup(left)]
    comp = {i: c for i, _, c in jaccard_components(left)}
    left = [(i, t) for i, t in left if comp[i] == i]
    items = [decontam.normal_words(t) for _, t in test]
    left = [(i, t) for i, t in left if not any(decontam.align(x, decontam.normal_words(t)) >= decontam.MIN_SCORE * 2 * len(x) for x in items)]
    enc = packing.WordEncoder(packing.default_tokenizer())
    assert got == Counter((i, len(enc.encode([t])[0]) // 2 + 1) for i, t in left)
    assert {n for n, _ in got} & set(range(300, 304)) == set() and len(got) > 40


def test_stages_keep_the_columns(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").selectExpr("*", "1 AS n_lines", "'x' AS k", "2 AS component_id")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, small_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.filter("text IS NOT NULL AND n_chars <> length(text)").count() == 0
        empty = stage(spark, docs.limit(0), small_dir)
        assert empty.columns == docs.columns and empty.count() == 0
    assert P.STAGES[-1][1](spark, docs.limit(0), small_dir).count() == 0


def test_stage_rows_only_shrink(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, small_dir)
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= ids, name
