"""Chat formatting with Spark expressions only.

Turns are collected per conversation as structs, sorted, adjacent turns of one role are
merged with array aggregation, and everything is concatenated.  Template:

    <s>ROLE[INST]TEXT[/INST][INST]TEXT[/INST]</s>   one block per run of equal roles

A control string (``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) inside a role or text gets a
backslash after its first character (one more if it already has some), which is undone
when reading back, so formatting is reversible for any text.  The loss mask holds the
spans of the assistant texts in the formatted string, in code points (``start``, ``len``)
and in UTF-8 bytes (``byte_start``, ``byte_len``), which reach a text without counting the
code points before it.  Work grows with n log n in the turns of a conversation.

Defined results: a null text or role is empty; ties of ``turn`` are ordered by role, then
text; repeated rows are turns of their own; null turns come first; rows with a null
conversation id form one conversation with a null id; extra columns are ignored; an
empty table gives an empty result.  A conversation is one output string, so its turns
meet in one row by definition; no other rows do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, TURN, END = "<s>", "</s>", "[INST]", "[/INST]"
MARKS = len(TURN) + len(END)
_TAIL = r"(/?s>|/?INST\])"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])\\(\\*)" + _TAIL, r"$1$2$3")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans`` with one row per conversation."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # a turn opens a block if its role differs from the turn before it, and closes one if
    # its role differs from the turn after it
    pieces = conv.withColumn("ps", F.transform("ts", lambda t, i: F.struct(
        F.when((i > 0) & (F.get("ts", i - 1)["role"] == t["role"]), F.lit(""))
        .otherwise(F.concat(F.lit(OPEN), escape(t["role"]))).alias("head"),
        escape(t["text"]).alias("body"),
        F.when(F.coalesce(F.get("ts", i + 1)["role"] == t["role"], F.lit(False)), F.lit(""))
        .otherwise(F.lit(CLOSE)).alias("tail"),
        (t["role"] == loss_role).alias("loss"))))
    whole = pieces.withColumn("formatted", F.array_join(F.transform(
        "ps", lambda p: F.concat(p["head"], F.lit(TURN), p["body"], F.lit(END), p["tail"])), ""))
    whole = whole.withColumn("starts", F.transform("ps", lambda p: F.struct(
        (F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"]) + MARKS).alias("chars"),
        (F.octet_length(p["head"]) + F.octet_length(p["body"]) + F.octet_length(p["tail"]) + MARKS).alias("bytes"))))
    # end of each turn, then of its body: what follows the body is cut off again
    spans = F.zip_with("ps", running_totals(F.col("starts")), lambda p, end: F.struct(
        (end["chars"] - F.length(p["tail"]) - len(END) - F.length(p["body"])).alias("start"), F.length(p["body"]).alias("len"),
        (end["bytes"] - F.octet_length(p["tail"]) - len(END) - F.octet_length(p["body"])).alias("byte_start"),
        F.octet_length(p["body"]).alias("byte_len"), p["loss"].alias("loss")))
    return whole.select("conv_id", "formatted", F.transform(F.filter(spans, lambda x: x["loss"]), lambda x: F.struct(
        x["start"], x["len"], x["byte_start"], x["byte_len"])).alias("loss_spans"))


def running_totals(lengths: Column) -> Column:
    """Running totals of an array of ``(chars, bytes)`` structs.  Step k adds to each element
    the one 2^(k-1) places before it, so n elements take log2(n) steps over the array."""
    def before(a, i, k, field):
        return F.coalesce(F.get(a, i - F.call_function("shiftleft", F.lit(1), k - 1))[field], F.lit(0))

    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.size(lengths))).cast("int")))
    return F.aggregate(steps, lengths, lambda a, k: F.transform(a, lambda x, i: F.struct(
        (x["chars"] + before(a, i, k, "chars")).alias("chars"), (x["bytes"] + before(a, i, k, "bytes")).alias("bytes"))))


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def read_back(formatted: Column) -> Column:
    """Array of ``(role, text)`` turns of a formatted string."""
    blocks = F.filter(F.split(formatted, r"</s>"), lambda b: b != "")

    def turns(b):
        return bound(F.split(F.regexp_replace(b, r"^<s>", ""), r"\[INST\]"), lambda parts: bound(
            unescape(F.get(parts, F.lit(0))), lambda role: F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda x: F.struct(
                role.alias("role"), unescape(F.regexp_replace(x, r"\[/INST\]$", "")).alias("text")))))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, joined without separator."""
    return bound(formatted.cast("binary"), lambda raw: F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(raw, s["byte_start"] + 1, s["byte_len"]).cast("string"))), ""))


def chat_digest(chats: DataFrame) -> DataFrame:
    """Digests of what can be read back from ``format_chats`` output."""
    d = chats.withColumn("rb", read_back(F.col("formatted"))).withColumn("lt", loss_text(F.col("formatted"), F.col("loss_spans")))
    return d.select(
        "conv_id", F.size("rb").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("rb", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("lt").cast("long").alias("loss_chars"), F.sha2("lt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS et,
        regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS er,
        CASE WHEN lag(role) OVER w IS NOT DISTINCT FROM role THEN 0 ELSE 1 END AS opens
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(et) + 13 + opens * (length(er) + 7))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
