"""Quality rules: one threshold table compiled into one Spark projection.

A rule is ``(name, measure, comparison, bound)``.  The measures are columns computed by
Spark expressions over the whole text (no user functions, no shuffle: every document is
judged inside its own row, so a hot source or a long text changes nothing).

Defined results: a null or empty text has no words, fails the base rule and is not kept.
Repeated rows are judged alike, an empty table gives an empty result, a null id is
carried through, and extra columns are passed on by ``filter_quality`` and ignored by
``quality_report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventfeat.llm.common import SPACE_CLASS, words

# Common function words of the corpus languages (en, fr, es, de).
STOP_WORDS = (
    "the of and to a in is that it for was on with as this be by are at from or an not have "
    "de la le et les des en du un que une pour est qui dans par sur au pas avec "
    "el y los las del se no por con su para una es al lo "
    "der die und den das von zu mit sich auf für nicht dem ist im ein eine als"
).split()

SYMBOLS = "#*$%&|<>"

#: A document that meets any of these conditions is rejected.
RULES = (
    ("too_short", "n_words", "<", 50),
    ("mostly_repeated", "repeat_ratio", ">", 0.5),
    ("symbols", "symbol_ratio", ">", 0.1),
    ("mean_word_short", "mean_word", "<", 3.0),
    ("mean_word_long", "mean_word", ">", 12.0),
    ("few_stop_words", "stop_ratio", "<", 0.1),
    ("repeated_lines", "dup_line_ratio", ">", 0.4),
)
BASE_MIN_WORDS, BASE_REPEAT_PERCENT = 50, 50


def _stop_forms(stops: tuple[str, ...] | list[str]) -> list[str]:
    """Each stop word as it may stand in a text: first letter either case, with or
    without a comma or full stop."""
    return sorted({f"{w}{p}" for s in stops for w in (s, s.capitalize()) for p in ("", ",", ".")})


def _measured(df: DataFrame, text: Column, stops) -> DataFrame:
    """Adds ``__``-named measure columns.  Each array is a column of its own step, so no
    step is evaluated twice."""
    d = df.withColumn("__t", F.coalesce(text, F.lit(""))).withColumn("__w", words(F.col("__t")))
    d = d.withColumn("__n", F.size("__w"))
    # three-word windows as (hash, position), sorted: equal windows become neighbours
    d = d.withColumn("__k", F.slice(F.transform("__w", lambda x, i: F.struct(
        F.xxhash64(x, F.get(F.col("__w"), i + 1), F.get(F.col("__w"), i + 2)).alias("h"), i.alias("i"))),
        F.lit(1), F.greatest(F.col("__n") - 2, F.lit(0))))
    d = d.withColumn("__s", F.sort_array("__k"))

    def repeated(x, j):
        return ((F.get(F.col("__s"), j - 1)["h"] == x["h"]) | (F.get(F.col("__s"), j + 1)["h"] == x["h"]))

    d = d.withColumn("__p", F.sort_array(F.transform(
        F.filter("__s", lambda x, j: F.coalesce(repeated(x, j), F.lit(False))), lambda x: x["i"])))
    # words covered by windows that start at the sorted positions: each adds min(3, gap)
    d = d.withColumn("__cover", F.aggregate(
        "__p", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"]).cast("long")).alias("n")),
        lambda a: a["n"]))
    d = d.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    forms = _stop_forms(stops)
    # one row from a generator: a filter on a measure is then not pushed below the steps
    # above, which would repeat each of them once for every use
    return d.select(*df.columns, F.inline(F.array(F.struct(
        F.col("__n").cast("long").alias("__n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("__word_chars"),
        (F.length("__t") - F.length(F.regexp_replace("__t", r"[#*$%&|<>]+", ""))).cast("long").alias("__n_symbols"),
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__n_dup_lines"),
        F.col("__cover").alias("__n_repeat_words"),
        F.size(F.filter("__w", lambda x: x.isin(forms))).cast("long").alias("__n_stop")))))


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _compiled(rules) -> Column:
    """The threshold table as one column: the names of the rules that a row breaks."""
    measures = {
        "n_words": F.col("__n_words"),
        "mean_word": _ratio("__word_chars", "__n_words"),
        "symbol_ratio": _ratio("__n_symbols", "__n_words"),
        "stop_ratio": _ratio("__n_stop", "__n_words"),
        "dup_line_ratio": _ratio("__n_dup_lines", "__n_lines"),
        "repeat_ratio": _ratio("__n_repeat_words", "__n_words"),
    }
    tests = [F.when(measures[m] < b if op == "<" else measures[m] > b, F.lit(name)) for name, m, op, b in rules]
    return F.array_compact(F.array(*tests))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES,
                   stop_words=STOP_WORDS) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``kept`` and the broken rules."""
    d = _measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text")), F.col("__text"), stop_words)
    base = (F.col("__n_words") < BASE_MIN_WORDS) | (
        100 * F.col("__n_repeat_words") > BASE_REPEAT_PERCENT * F.col("__n_words"))
    return d.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__word_chars").alias("word_chars"),
        F.col("__n_symbols").alias("n_symbols"), F.col("__n_dup_lines").alias("n_dup_lines"),
        F.col("__n_repeat_words").alias("n_repeat_words"), base.alias("base_failed"),
        _compiled(rules).alias("broken"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def filter_quality(docs: DataFrame, text_col: str = "text", rules=RULES, stop_words=STOP_WORDS) -> DataFrame:
    """The rows of ``docs`` (all their columns) that break no rule."""
    d = _measured(docs, F.col(text_col), stop_words)
    base = (F.col("__n_words") < BASE_MIN_WORDS) | (
        100 * F.col("__n_repeat_words") > BASE_REPEAT_PERCENT * F.col("__n_words"))
    return d.filter(~base & (F.size(_compiled(rules)) == 0)).select(*docs.columns)


def oracle_sql(rules=RULES, stop_words=STOP_WORDS) -> str:
    """The same report in DuckDB SQL."""
    sp = r"[\x20\x09-\x0D]"
    forms = ", ".join("'" + f.replace("'", "''") + "'" for f in _stop_forms(stop_words))
    measure = {
        "n_words": "n_words", "mean_word": "word_chars / greatest(n_words, 1)",
        "symbol_ratio": "n_symbols / greatest(n_words, 1)", "stop_ratio": "n_stop / greatest(n_words, 1)",
        "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
        "repeat_ratio": "n_repeat_words / greatest(n_words, 1)",
    }
    broken = " OR ".join(f"({measure[m]} {op} {b})" for _, m, op, b in rules)
    names = ", ".join(f"CASE WHEN {measure[m]} {op} {b} THEN '{n}' END" for n, m, op, b in rules)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, list_filter(string_split_regex(t, '{sp}+'), lambda x: x <> '') AS w FROM d),
tok AS (SELECT rid, unnest(w) AS x, unnest(range(len(w))) AS i FROM w),
win AS (SELECT rid, i, x || ' ' || lead(x) OVER p || ' ' || lead(x, 2) OVER p AS g
        FROM tok WINDOW p AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win WHERE g IS NOT NULL),
cov AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words
        FROM rep, (SELECT unnest([0, 1, 2]) AS o) WHERE c > 1 GROUP BY rid),
m AS (SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
        len(list_filter(w.w, lambda x: x IN ({forms})))::BIGINT AS n_stop,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
z AS (SELECT *, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words) AS base_failed,
  list_filter([{names}], lambda x: x IS NOT NULL) AS broken,
  NOT (n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words OR {broken}) AS kept
FROM z"""
