"""Conversation repair against a shortest-path search over single rows."""

import heapq
import random
import re
import zlib

from eventfeat.llm import repair
from eventfeat.llm.queries import QUERIES
from tests.llm.helpers import rows_of, sha

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_repair(rows):
    """(cost, audit, lines) of rows ``(role, text, fault)``: search by (cost, audit)."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        due = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[due]
        heapq.heappush(heap, (cost + 3, audit + "I", i, due, (*lines, f"{name}:")))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, lines))
        if fault in ("blank", "duplicate"):
            continue
        cost += 3 * (fault == "truncated")
        if role[:1] == due or (role[:1] == "s" and last == ""):
            heapq.heappush(heap, (cost, audit + "K", i + 1, role[0], (*lines, f"{role}:{text}")))
        heapq.heappush(heap, (cost + 3, audit + "R", i + 1, due, (*lines, f"{name}:{text}")))


def plain_report(table):
    """The contract's rows for the conversations of ``(conv_id, turn, role, text)`` rows."""
    convs = {c: [] for c, *_ in table}
    for c, t, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [] if kind == 0 else [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, *_ in rows if t is not None}
        cost, audit, lines = plain_repair([(r, x, f) for (_, r, x), f in zip(rows, faults)])
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit, sha("\n".join(lines))))
    return sorted(out, key=repr)


def odd_rows(seed, convs):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Fine.", "Fine.", "What?", "cut off", " \t", "", None, "Über!\n ", "a.b", f"own {rng.random()}."])
            rows.append((c, rng.choice([t, t, t, t * 3, None]), role, text))
    return rows + rng.sample(rows, len(rows) // 8)


def run(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "'x' AS audit", "2 AS copies").write.parquet(f"{path}/conversations.parquet")
    return QUERIES["op12_conversation_structure_repair"](spark, str(path))


def test_whole_query_on_odd_rows(spark, tmp_path):
    rows = odd_rows(2, [None, *range(250)]) + [(900, 5, "user", "same."), *[(901, 1, "user", "same.")] * 40]
    rows += [(902, None, "assistant", "null turns."), (902, None, "user", "only?")]
    got = run(spark, rows, tmp_path)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert rows_of(got) == plain_report(rows)


def test_one_long_conversation(spark, tmp_path):
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "user", "assistant"]), f"Turn {t if rng.random() < 0.7 else 0}{rng.choice(['.', '.', ''])}") for t in range(4000)]
    assert rows_of(run(spark, rows + odd_rows(3, range(2, 30)), tmp_path)) == plain_report(rows + odd_rows(3, range(2, 30)))


def test_everything_dropped_and_empty_table(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert rows_of(run(spark, [(gone, 0, "user", "Hello.")], tmp_path / "a")) == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert run(spark, [], tmp_path / "b").count() == 0


def test_repaired_turns_have_the_form(spark):
    conv, turns = repair.repair_turns(spark.createDataFrame(odd_rows(9, range(60)), SCHEMA))
    whole = {}
    for r in sorted(turns.collect(), key=lambda r: (r.place, r.item)):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.role[0]
    assert all(re.fullmatch("s?(ua)+", x) for x in whole.values())
    assert {r.conv_id for r in conv.collect()} == set(range(60))


def test_powers_equal_single_steps():
    repairer = repair.Repairer()
    for symbol in [repair.DELETE, *((r, False, cut) for r in "sua " for cut in (False, True))]:
        step = repair.LAST
        for count in range(1, 40):
            step = repairer.advance(symbol, 1, step)
            assert repairer.advance(symbol, count, repair.LAST) == step
    cost, letters, _ = repairer.repair([(("u", False, False), 50_000)])
    assert cost == 75_000 and letters == ["KR" * 25_000]


def test_runs_of_random_symbols():
    rng, repairer = random.Random(1), repair.Repairer()
    for _ in range(1500):
        rows = [(rng.choice([repair.DELETE, *((r, False, cut) for r in "sua " for cut in (False, True))]), rng.choice([1, 1, 2, 5, 9]))
                for _ in range(rng.randint(1, 6))]
        flat = [(s[0], "x", "blank" if s[1] else "truncated" if s[2] else "") for s, n in rows for _ in range(n)]
        cost, letters, _ = repairer.repair(rows)
        assert (cost, "".join(letters)) == plain_repair(flat)[:2]
