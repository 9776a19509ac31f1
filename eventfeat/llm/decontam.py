"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Word frequencies of the corpus go into a count sketch of fixed size.  A three-word
   n-gram of a test item is a rare seed if the product of its words' frequencies is below
   ``rare``, whatever the corpus size; every item also keeps its rarest few, and the
   rarest of every ``run`` words in a row.
2. The seeds go into a Bloom filter of fixed size.  Each document is searched for them in
   whole; seeds that lie close together form one region, and regions are joined with the
   test items through the seeds themselves.
3. Each (region, item) pair is aligned by Smith-Waterman over words (match 2, mismatch and
   gap -1).  The score as a share of the item's best possible score tells a copy, also an
   edited or paraphrased one, from chance.  ``run`` words of an item in a row, word for
   word, are a leak whatever their share of the item.

Words are lower-cased, and ASCII punctuation separates them.  Defined results: null or
empty texts and items match nothing; items below ``min_words`` words match where all their
words stand in a row (no lower score tells them from chance), and items below ``N`` words
where they are the whole text; repeated rows report alike, once per id and item; a null id
is reported as null; an empty table on either side gives an empty result; extra columns
are ignored by ``leaks`` and passed on by ``without_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfeat.llm import seen
from eventfeat.llm.common import written

N = 3                 # words per seed
SKETCH = 1 << 16      # buckets of the word count sketch
RARE = 1e-9           # highest expected frequency of a rare seed
ALWAYS = 4            # seeds that an item keeps even if none is rare
MIN_WORDS = 8
RUN = 13              # words in a row that are a leak by themselves
MIN_SCORE = 0.40      # share of the item's best possible score; 0.33 is the highest of clean text in check_s
REACH = 2             # a region reaches this many item lengths around its seeds
_PUNCT = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PUNCT).split()


def _hashes(words: list[bytes]):
    import numpy as np
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def _grams(h):
    """Hash of the n-gram at each start."""
    import numpy as np

    n = max(0, len(h) - N + 1)
    g = np.zeros(n, np.uint64)
    for i in range(N):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
        g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(32))


def align(item: list[bytes], words: list[bytes]) -> int:
    """Best Smith-Waterman score of ``item`` anywhere in ``words``."""
    import numpy as np

    number: dict[bytes, int] = {}
    a = [number.setdefault(w, len(number)) for w in item]
    b = np.array([number.get(w, -1) for w in words])
    steps = np.arange(len(b) + 1)
    row, best = np.zeros(len(b) + 1, np.int64), 0
    for x in a:
        new = np.maximum(row - 1, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(b == x, 2, -1))
        row = np.maximum.accumulate(new + steps) - steps  # gaps along the row cost 1 each
        best = max(best, int(row.max()))
    return best


def longest_run(item: list[bytes], words: list[bytes]) -> int:
    """Most words in a row that ``item`` and ``words`` have in common."""
    import numpy as np

    number: dict[bytes, int] = {}
    a = [number.setdefault(w, len(number)) for w in item]
    b = np.array([number.get(w, -1) for w in words])
    row, best = np.zeros(len(b) + 1, np.int64), 0
    for x in a:
        row[1:] = np.where(b == x, row[:-1] + 1, 0)
        best = max(best, int(row.max()))
    return best


def _filled(h):
    """A text below ``N`` words has one n-gram, of itself and nothing more."""
    import numpy as np

    return np.r_[h, np.zeros(max(0, N - len(h)), np.uint64)] if len(h) else h


def _counted(batches) -> Iterator:
    """Words of a task, counted by sketch bucket."""
    import numpy as np
    import pyarrow as pa

    def counted(words):
        return np.bincount(((_hashes(words) >> np.uint64(24)) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)

    total, held = np.zeros(SKETCH, np.int64), []
    for b in batches:
        for text in b.column(0).to_pylist():
            held += normal_words(text)
            if len(held) >= 1 << 18:
                total += counted(held)
                held = []
    total += counted(held)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())],
                                     schema=pa.schema([("bucket", pa.int64()), ("n", pa.int64())]))


def _seeds(shared, rare: float, run_words: int):
    """(item, h) of the seeds of each test item."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        freq = shared.value
        for b in batches:
            items, hs = [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = normal_words(text)
                if not w:
                    continue
                h = _filled(_hashes(w))
                f = freq[((h >> np.uint64(24)) & np.uint64(SKETCH - 1)).astype(np.int64)]
                g = _grams(h)
                p = np.prod([f[k:k + len(g)] for k in range(N)], axis=0)
                keep = (p < rare) | (np.argsort(np.argsort(p, kind="stable")) < ALWAYS)
                size = max(1, run_words - N + 1)  # n-grams of a run
                for k in range(len(g) - size + 1):
                    keep[k + np.argmin(p[k:k + size])] = True
                for x in np.unique(g[keep].view(np.int64)).tolist():
                    items.append(i)
                    hs.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(hs, pa.int64())],
                                             schema=pa.schema([("item", pa.int64()), ("h", pa.int64())]))

    return run


def _member_messages(p: seen.Plan):
    """Seeds sent twice each: the twice-seen filter then holds exactly them."""

    def run(batches) -> Iterator:
        import numpy as np

        return seen.send((np.repeat(b.column(0).to_numpy().view(np.uint64), 2) for b in batches), p)

    return run


def _regions(p: seen.Plan, shared, reach: int):
    """Rows (row, id, start, words, seeds) of the regions of each document with seeds."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("start", pa.int32()), ("words", pa.binary()),
                            ("seeds", pa.list_(pa.int64()))])
        for b in batches:
            out = [[] for _ in schema]
            for row, i, text in zip(*(b.column(n).to_pylist() for n in range(3))):
                w = normal_words(text)
                if not w:
                    continue
                g = _grams(_filled(_hashes(w)))
                at = np.flatnonzero(seen.hits(shared.value, g, p))
                if not len(at):
                    continue
                for part in np.split(at, np.flatnonzero(np.diff(at) > reach) + 1):
                    a, z = max(0, int(part[0]) - reach), min(len(w), int(part[-1]) + N + reach)
                    for col, v in zip(out, (row, i, a, b" ".join(w[a:z]), np.unique(g[part].view(np.int64)).tolist())):
                        col.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def _aligned(min_score: float, min_words: int, run_words: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())])
        for b in batches:
            out = [[] for _ in schema]
            for row, i, item, words, text in zip(*(b.column(n).to_pylist() for n in range(5))):
                w = normal_words(text)
                words = words.split()
                score = align(w, words) / (2 * len(w))
                if len(w) < N:
                    found = w == words
                elif len(w) < min_words:
                    found = longest_run(w, words) == len(w)
                else:
                    found = score >= min_score or score * len(w) >= run_words and longest_run(w, words) >= run_words
                if found:
                    for col, v in zip(out, (row, i, item, score)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col, text_col, item_col, item_text, rare, min_words, min_score, run) -> DataFrame:
    import numpy as np

    spark = docs.sparkSession
    d = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), F.col(id_col).cast("long").alias("id"),
                    F.col(text_col).cast("string").alias("text"))
    tests = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("item_text"))
    # test sets are kept by row: a null or repeated item id still finds its own text
    tests = tests.withColumn("key", F.xxhash64("item", "item_text")).dropDuplicates(["key"])

    counts = d.select("text").mapInArrow(_counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    freq = np.zeros(SKETCH)
    for bucket, n in counts.collect():  # SKETCH rows at most
        freq[bucket] = n
    shared = spark.sparkContext.broadcast(freq / max(1.0, freq.sum()))
    seeds = written(tests.select("key", "item_text").mapInArrow(_seeds(shared, rare, run), "item long, h long"), "seeds")

    p = seen.plan(spark)
    member = seen.twice_seen(seeds.select("h").mapInArrow(_member_messages(p), seen.MESSAGES), p)
    # words as normal_words cuts them
    longest = tests.agg(F.max(F.regexp_count("item_text", F.lit(r"[^\p{Punct}\s]+")))).first()[0] or 0
    regions = written(d.mapInArrow(_regions(p, member, REACH * max(longest, MIN_WORDS)),
                                   "row long, id long, start int, words binary, seeds array<long>"), "regions")
    # a row is known by its id and the hash of id and text
    pairs = regions.select("row", F.col("id").alias("of"), "start", F.explode("seeds").alias("h")).join(seeds, "h").select(
        "row", "of", "start", "item").distinct()
    # rows of equal id and text have equal regions: one of them is enough
    whole = regions.dropDuplicates(["row", "id", "start"]).select("row", "start", "id", "words")
    both = pairs.join(whole, ["row", "start"]).filter(F.col("of").eqNullSafe(F.col("id"))).join(tests.select(F.col("key").alias("item"), F.col("item").alias("item_id"), "item_text"), "item")
    return both.select("row", "id", "item_id", "words", "item_text").mapInArrow(
        _aligned(min_score, min_words, run), "row long, doc_id long, item_id long, score double")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", rare: float = RARE, min_words: int = MIN_WORDS, min_score: float = MIN_SCORE,
          run: int = RUN) -> DataFrame:
    """``doc_id, item_id, score`` of every document that holds a test item, an edited
    copy of it or ``run`` of its words in a row."""
    found = _leaks(docs, benchmark, id_col, text_col, item_col, item_text, rare, min_words, min_score, run)
    return found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", rare: float = RARE, min_words: int = MIN_WORDS,
                  min_score: float = MIN_SCORE, run: int = RUN) -> DataFrame:
    """The rows of ``docs`` (all their columns) that hold no test item."""
    found = _leaks(docs, benchmark, id_col, text_col, item_col, item_text, rare, min_words, min_score, run)
    rows = written(found.select(F.col("row").alias("__leak"), F.col("doc_id").alias("__of")).distinct(), "leaks")
    return docs.withColumn("__row", F.xxhash64(F.col(id_col), F.col(text_col))).join(
        rows, (F.col("__row") == F.col("__leak")) & F.col(id_col).cast("long").eqNullSafe(F.col("__of")), "left_anti").select(*docs.columns)
