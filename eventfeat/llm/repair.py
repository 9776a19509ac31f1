"""Structure repair of conversations by a run-length min-plus dynamic program.

A repaired conversation is empty, or an optional system turn and then user/assistant
pairs.  Each row is kept, reroled or deleted, and empty turns may be inserted; the
cheapest edits are chosen, the ASCII-least audit among equals.

1. Equal rows (conversation, turn, role and text) are counted before anything is sorted,
   so copies cost one row.  The rest is range-partitioned by (conversation, turn, role,
   text), so a conversation of any size spreads over tasks, and written with its place.
2. The first place of each (conversation, role, text) is one aggregate; a join by place,
   which no key can make hot, marks the other rows as duplicates.
3. A row is one symbol: its role's initial and its fault.  Symbols and places, not texts,
   meet per conversation.  Equal neighbours collapse to runs.  A symbol is a 4 x 4 min-plus
   matrix over the states start, system, user, assistant; a run of ``c`` goes through the
   binary powers of its matrix, which are cached.  Choices are then unrolled: inside a run
   the cost vectors repeat after a few rows up to a constant, and so do the choices.
4. The edits of each row go back to its text by place.  A conversation's symbols and edits
   are of the size of its audit, one output value; its texts never meet in this operator.

Defined results: null roles and texts count as one space; null turns come first; equal
turns are ordered by role, then text; repeated rows are duplicates, equal to rows of their
own; rows with a null conversation id form one conversation with a null id; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfeat.llm.common import SPACE_CLASS, written

START, SYSTEM, USER, ASSISTANT = range(4)
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}  # fixed values of the contract
TRUNCATED_COST = 3
FAR = 1 << 60  # cost of what is not allowed
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: state after an inserted or reroled turn
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: state after a kept turn, by its role's initial; else it cannot be kept
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
DELETE = ("", True, False)  # symbol of blank and duplicate rows: (initial, must go, truncated)

_EDITS = "array<struct<place:long,items:array<struct<own:boolean,role:string>>>>"
_SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           f"edits {_EDITS}")


def choices(symbol: tuple, state: int) -> list[tuple[str, int, int]]:
    """Row edits ``(letter, cost, next state)`` of a symbol in ASCII order of letters."""
    initial, must_go, truncated = symbol
    out = [("D", COSTS["D"], state)]
    if not must_go:
        more = TRUNCATED_COST * truncated
        if state in KEEP.get(initial, ()):
            out.append(("K", COSTS["K"] + more, KEEP[initial][state]))
        out.append(("R", COSTS["R"] + more, NEXT[state]))
    return out


def _inserts() -> list[list[int]]:
    """Cheapest cost of insertions from state to state."""
    out = [[FAR] * 4 for _ in range(4)]
    for q in range(4):
        at, cost = q, 0
        for _ in range(4):
            out[q][at] = min(out[q][at], cost)
            at, cost = NEXT[at], cost + COSTS["I"]
    return out


def _times(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    return [[min(min(a[q][k] + b[k][r] for k in range(4)), FAR) for r in range(4)] for q in range(4)]


def _apply(a: list[list[int]], v: tuple) -> tuple:
    return tuple(min(min(a[q][k] + v[k] for k in range(4)), FAR) for q in range(4))


INSERTS = _inserts()
#: cost still to come behind the last row: only the start and an assistant may be last
LAST = _apply(INSERTS, (0, FAR, FAR, 0))


class Repairer:
    """Min-plus steps with caches for the powers of a symbol and for choices."""

    def __init__(self):
        self.powers: dict[tuple, list] = {}
        self.tables: dict[tuple, tuple] = {}

    def advance(self, symbol: tuple, count: int, after: tuple) -> tuple:
        """Cost vector before ``count`` rows of a symbol."""
        powers = self.powers.get(symbol)
        if powers is None:
            row = [[FAR] * 4 for _ in range(4)]
            for q in range(4):
                for _, cost, r in choices(symbol, q):
                    row[q][r] = min(row[q][r], cost)
            powers = self.powers[symbol] = [_times(INSERTS, row)]
        bit = 0
        while count >> bit:
            if bit == len(powers):
                powers.append(_times(powers[-1], powers[-1]))
            if count >> bit & 1:
                after = _apply(powers[bit], after)
            bit += 1
        return after

    def table(self, symbol: tuple, after: tuple) -> tuple:
        """For each state ``(letters, items, next state)`` of the least cheapest edits of
        one row with the cost vector ``after`` behind it, and the vector before it; both
        vectors without their least cost."""
        got = self.tables.get((symbol, after))
        if got is None:
            before = self.advance(symbol, 1, after)
            rows = []
            for q in range(4):
                letters, items, at = "", [], q
                while True:
                    best = before[at]
                    moves = [(c, cost + after[r], r) for c, cost, r in choices(symbol, at)]
                    moves.append(("I", COSTS["I"] + before[NEXT[at]], NEXT[at]))
                    c, _, r = min(m for m in moves if m[1] == best) if best < FAR else ("D", 0, at)
                    letters += c
                    if c != "D":
                        items.append((c != "I", None if c == "K" else NAMES[r]))
                    at = r
                    if c != "I":
                        break
                rows.append((letters, items, at))
            got = self.tables[symbol, after] = rows, _least(before)
        return got

    def repair(self, rows: list[tuple[tuple, int]]) -> tuple[int, list[str], list[list]]:
        """Cost, letters and items of each ``(symbol, count)`` of a conversation."""
        runs: list[list] = []  # symbol, count, members
        for k, (symbol, count) in enumerate(rows):
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += count
                runs[-1][2].append(k)
            else:
                runs.append([symbol, count, [k]])
        vectors = [LAST]
        for symbol, count, _ in reversed(runs):
            vectors.append(self.advance(symbol, count, vectors[-1]))
        cost, at = vectors.pop()[START], START
        letters, items = [""] * len(rows), [[] for _ in rows]
        for symbol, count, members in runs:
            after = vectors.pop()
            if symbol == DELETE:
                for k in members:
                    letters[k] = "D" * rows[k][1]
                continue
            # tables by the number of rows left in the run, until the vectors come back
            after, tables, seen = _least(after), [], {}
            while after not in seen and len(tables) < count:
                seen[after] = len(tables)
                table, after = self.table(symbol, after)
                tables.append(table)
            back = seen.get(after, 0)
            left = count
            for k in members:
                parts = []
                for _ in range(rows[k][1]):
                    left -= 1
                    n = left if left < len(tables) else back + (left - back) % (len(tables) - back)
                    got, new, at = tables[n][at]
                    parts.append(got)
                    items[k] += new
                letters[k] = "".join(parts)
        while at not in (START, ASSISTANT):
            at = NEXT[at]
            letters[-1] += "I"
            items[-1] = items[-1] + [(False, NAMES[at])]
        return cost, letters, items


def _least(v: tuple) -> tuple:
    low = min(v)
    return tuple(x - low if x < FAR else FAR for x in v)


def _report(repairer: Repairer, rows: list[dict]) -> dict:
    """Counts, cost, audit and edits of one conversation's rows, which come in order."""
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    out = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    symbols, owners, last = [], [], None
    for k, r in enumerate(rows):
        n, role = r["copies"], r["initial"]
        out["illegal"] += (last is not None and last + role not in ("su", "ua", "au")) + n - 1
        last = role
        again = n if r["seen"] else n - 1  # copies behind the first
        if r["fault"] == "blank":
            out["blank"] += n
        else:
            out["duplicate"] += again
            if not r["seen"]:
                cut = r["fault"] == "truncated"
                out["truncated"] += cut
                symbols.append(((role, False, cut), 1))
                owners.append(k)
        gone = n if r["fault"] == "blank" else again
        if gone:
            symbols.append((DELETE, gone))
            owners.append(k)
    cost, letters, items = repairer.repair(symbols)
    by_place: dict[int, list] = {}
    for k, new in zip(owners, items):
        if new:
            by_place.setdefault(rows[k]["place"], []).extend(dict(zip(("own", "role"), x)) for x in new)
    edits = [{"place": p, "items": x} for p, x in by_place.items()]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return out | {"gaps": gaps, "cost": cost, "audit": "".join(letters), "edits": edits}


def _repaired(batches) -> Iterator:
    import pyarrow as pa

    item = pa.struct([("own", pa.bool_()), ("role", pa.string())])
    edit = pa.struct([("place", pa.int64()), ("items", pa.list_(item))])
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "edits")
    kinds = [pa.int64()] * 7 + [pa.string(), pa.list_(edit)]
    repairer = Repairer()
    for b in batches:
        for at in range(0, b.num_rows, 256):
            some = b.slice(at, 256)
            got = [{"conv_id": c} | _report(repairer, rows) for c, rows in zip(some.column(0).to_pylist(), some.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([g[n] for g in got], k) for n, k in zip(names, kinds)], names=list(names))


def repair_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(conversations, turns)``: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit`` per conversation, and ``conv_id, place, item, role, text`` of each turn of
    the repaired conversations, in order of ``place`` and ``item``."""
    d = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                    F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    order = ("conv_id", "turn", "role", "text")
    d = d.groupBy(*order).agg(F.count("*").alias("copies"))
    d = d.repartitionByRange(*order).sortWithinPartitions(*order)
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(
        ~F.col("text").rlike(r"[.!?]" + SPACE_CLASS + r"*\z"), "truncated").otherwise("none")
    d = written(d.select(*order, "copies", F.monotonically_increasing_id().alias("place"), fault.alias("fault"),
                         F.sha2(F.to_json(F.struct("role", "text")), 256).alias("said")), "turns")
    first = d.groupBy("conv_id", "said").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    marked = d.select("conv_id", "turn", "place", "copies", "fault", F.substring("role", 1, 1).alias("initial")).join(first, "place", "left")
    symbols = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "place", "turn", "initial", "fault", F.col("first").isNull().alias("seen"), F.col("copies").cast("long").alias("copies")))).alias("rows"))
    done = written(symbols.mapInArrow(_repaired, _SCHEMA), "repaired")
    edits = done.select(F.explode("edits").alias("e")).select("e.place", F.posexplode("e.items").alias("item", "x"))
    turns = edits.join(d.select("place", "conv_id", F.col("role").alias("own_role"), "text"), "place").select(
        "conv_id", "place", "item", F.coalesce("x.role", "own_role").alias("role"), F.when(F.col("x.own"), F.col("text")).otherwise("").alias("text"))
    return done.drop("edits"), turns


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to ``conv_id, turn, role, text`` (Spark expressions only)."""
    d = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    return d.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repair_report(ids: DataFrame, conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each conversation id of ``ids``, with a digest of its repaired turns."""
    lines = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "place", "item", F.concat("role", F.lit(":"), "text").alias("line")))).alias("lines"))
    digest = lines.select("conv_id", F.sha2(F.array_join("lines.line", "\n"), 256).alias("sha"))
    # grouping, unlike a join, takes null ids together
    one = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    kinds = dict(conversations.dtypes)
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in one]
    sha = F.lit(None).cast("string").alias("sha")
    rows = ids.select(F.col("conv_id").cast("long").alias("conv_id"), *none, sha).unionByName(
        conversations.select("conv_id", *one, sha)).unionByName(digest.select("conv_id", *none, "sha"))
    empty = {c: F.lit("") if c == "audit" else F.lit(0) for c in one}
    return rows.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), empty[c].cast(kinds[c])).alias(c) for c in one],
        F.coalesce(F.max("sha"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def oracle_sql() -> str:
    """The same report in SQL: forward dynamic program over (cost, audit, lines)."""
    def add(s: str, cost: str, letter: str, line: str | None) -> str:
        lines = f"{s}.lines" if line is None else f"list_append({s}.lines, {line})"
        return f"{{'cost': {s}.cost + {cost}, 'audit': {s}.audit || '{letter}', 'lines': {lines}}}"

    def least(*xs: str) -> str:
        return f"list_sort([{', '.join(xs)}])[1]"

    def insert(s: str, role: str) -> str:
        return add(s, "3", "I", f"'{role}:'")

    def turn(s: str, initials: str, role: str | None) -> str:
        more = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
        no = "CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000000 ELSE 0 END"
        keep = add(s, f"{more} + {no} + CASE WHEN left(role, 1) = '{initials}' THEN 0 ELSE 1000000000000 END", "K", "role || ':' || text")
        return keep if role is None else f"{keep}, {add(s, f'3 + {more} + {no}', 'R', f'''{chr(39)}{role}:{chr(39)} || text''')}"

    def gone(s: str) -> str:
        return add(s, "4", "D", None)

    byte = "lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    space = r"[\x20\x09-\x0D]"
    return f"""
WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
codes AS (SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT), {byte}), 4294967295) % 20 AS kind FROM named),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM codes WHERE kind <> 0),
placed AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faults AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?]{space}*\\z') THEN 'truncated' ELSE 'none' END AS fault,
    coalesce(left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1), 'ua') NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
counts AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank')::BIGINT AS blank, count(*) FILTER (fault = 'duplicate')::BIGINT AS duplicate,
    count(*) FILTER (fault = 'truncated')::BIGINT AS truncated, count(*) FILTER (illegal)::BIGINT AS illegal FROM faults GROUP BY conv_id),
steps AS (SELECT conv_id, 0::BIGINT AS i, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS s0,
    {{'cost': 1000000000000::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS s1, {{'cost': 1000000000000::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS s2,
    {{'cost': 1000000000000::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS s3 FROM counts
  UNION ALL SELECT conv_id, i,
    {gone('e0')} AS s0,
    {least(gone('e1'), turn('e0', 's', None))} AS s1,
    {least(gone('e2'), turn('e0', 'u', 'user'), turn('e1', 'u', 'user'), turn('e3', 'u', 'user'))} AS s2,
    {least(gone('e3'), turn('e2', 'a', 'assistant'))} AS s3
  FROM (SELECT s.conv_id, f.i, f.role, f.text, f.fault, s0 AS e0, s1 AS e1,
      {least('s2', insert('s0', 'user'), insert('s1', 'user'), insert('s3', 'user'))} AS e2,
      {least('s3', insert('s2', 'assistant'), 'i0', 'i1')} AS e3
    FROM (SELECT *, {insert('u0', 'assistant')} AS i0, {insert('u1', 'assistant')} AS i1
      FROM (SELECT *, {insert('s0', 'user')} AS u0, {insert('s1', 'user')} AS u1 FROM steps)) AS s
    JOIN faults f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1)),
ends AS (SELECT c.*, {least('s0', 's3', insert('s2', 'assistant'), insert('u1', 'assistant'))} AS best
  FROM (SELECT *, {insert('s1', 'user')} AS u1 FROM steps) AS s JOIN counts c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.n)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS a LEFT JOIN ends e ON a.conv_id IS NOT DISTINCT FROM e.conv_id"""
