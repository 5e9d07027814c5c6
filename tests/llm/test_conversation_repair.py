import hashlib
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import conversation_repair as R


def cheapest(rows):
    """(cost, audit) by trying the best string of every state after every row."""
    best = {R.START: (0, "")}

    def inserted(at):
        out = dict(at)
        for s, (cost, audit) in at.items():
            for _ in range(2):
                s, cost, audit = R.THEN[s], cost + R.INSERT, audit + "I"
                out[s] = min(out.get(s, (R.NEVER, "")), (cost, audit))
        return out

    for role, fault in rows:
        after = {}
        for s, (cost, audit) in inserted(best).items():
            ways = [("D", R.DELETE, s)]
            if fault not in (R.BLANK, R.DUPLICATE):
                extra = R.TRUNCATION * (fault == R.TRUNCATED)
                ways.append(("R", R.REROLE + extra, R.THEN[s]))
                if role == R.DUE[s]:
                    ways.append(("K", extra, R.THEN[s]))
                if role == "s" and s == R.START:
                    ways.append(("K", extra, R.LED))
            for e, more, t in ways:
                after[t] = min(after.get(t, (R.NEVER, "")), (cost + more, audit + e))
        best = after
    return min(v for s, v in inserted(best).items() if s in (R.START, R.ANSWERED))


def some_rows(rng, n, roles="suuaax", faults=(0, 0, 0, 0, 1, 2, 3)):
    return [(rng.choice(roles), rng.choice(faults)) for _ in range(n)]


def test_search_equals_trying_all():
    rng = random.Random(3)
    for _ in range(4000):
        rows = some_rows(rng, rng.randrange(12), rng.choice(["sua", "suuaax", "u", "sss", "au"]))
        assert R.Search(rows).best() == cheapest(rows), rows


def test_search_of_a_whole_segment_is_quick():
    rng = random.Random(4)
    for roles, faults in (("suuaax", (0, 0, 0, 0, 1, 2, 3)), ("u", (0,)), ("s", (0,)), ("ua", (3,)), ("x", (0, 3)), ("uuuuua", (0,))):
        rows = some_rows(rng, R.SEGMENT_ROWS, roles, faults)
        start = time.time()
        assert R.Search(rows).best() == cheapest(rows)
        assert time.time() - start < 3


def test_costs_between_states_compose():
    rng = random.Random(6)
    for _ in range(300):
        rows = some_rows(rng, rng.randrange(1, 14))
        k = rng.randrange(len(rows) + 1)
        to_go = R.AT_END
        for part in (rows[k:], rows[:k]):
            costs = R.costs_between(part)
            to_go = [min(costs[4 * s + t] + to_go[t] for t in range(4)) for s in range(4)]
        assert to_go[R.START] == cheapest(rows)[0]


def test_faults():
    assert [R.fault_of(t, False) for t in ("", " \t\n\x0b\x0c\r", "a.", "a? \n", "a", "é…", "\x1c")] == [1, 1, 0, 0, 3, 3, 3]
    assert R.fault_of("a.", True) == R.DUPLICATE and R.fault_of(" ", True) == R.BLANK


def sha(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(rows):
    """The contract row by row; ``rows``: (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r))
    seen, facts = set(), []
    for _, role, text in rows:
        facts.append((role[:1], R.fault_of(text, (role, text) in seen)))
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit = cheapest(facts)
    lines = [f"{r}:{t}" for r, t in R.walk(audit, [r[1] for r in rows], [r[2] for r in rows], R.START)[1]]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(f == k for _, f in facts) for k in (1, 2, 3)),
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:])), cost, audit, sha(lines))


def made(rng, conversations):
    out = []
    for c in range(conversations):
        for _ in range(rng.choice([1, 2, 5, 9, 40])):
            out.append((c, rng.choice([None, *range(30)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]),
                        rng.choice(["", " ", "Yes.", "No", f"t{rng.randrange(50)}.", f"t{rng.randrange(50)}", "a\nb."])))
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("limits", [{}, {"max_rows": 3}, {"max_bytes": 8}])
def test_repair_equals_the_contract(spark, limits):
    rng = random.Random(8)
    rows = made(rng, 60) + [(None, None, "user", "Hi."), (None, 3, "assistant", "Ho.")] + [(99, t // 3, "user", "Same.") for t in range(90)]
    got = {r[0]: tuple(r)[1:] for r in R.repair(spark.createDataFrame(rows, SCHEMA).repartition(5), **limits).collect()}
    by = {}
    for c, *r in rows:
        by.setdefault(c, []).append(tuple(r))
    assert got == {c: expected(r) for c, r in by.items()}


def test_repaired_rows_are_legal(spark):
    rows = spark.createDataFrame(made(random.Random(9), 40), SCHEMA)
    for limits in ({}, {"max_rows": 2}):
        found = sorted(R.repaired_rows(rows, **limits).collect(), key=lambda r: (r.conv_id, r["at"], r.number))
        by = {}
        for r in found:
            by.setdefault(r.conv_id, []).append((r.role, r.text))
        digest = {r.conv_id: r.repaired_sha256 for r in R.repair(rows).collect()}
        for c, lines in by.items():
            initials = "".join(r[:1] for r, _ in lines).removeprefix("s")
            assert initials == "ua" * (len(initials) // 2) and sha([f"{r}:{t}" for r, t in lines]) == digest[c]


def test_a_conversation_over_many_segments_and_tasks(spark):
    rng = random.Random(10)
    hot = [(1, t, rng.choice(["user", "assistant"]), f"{rng.randrange(900)}{rng.choice('.!x')}") for t in range(3000)]
    rows = spark.createDataFrame(hot + made(rng, 20), SCHEMA)
    cut = R.segments(R._clean(rows), 100, 1 << 20).where("conv_id = 1")
    assert cut.select("part").distinct().count() > 2 and cut.agg(F.max("rows")).first()[0] <= 100
    got = R.repair(rows, 100).where("conv_id = 1").first()
    assert tuple(got)[1:] == expected([tuple(r[1:]) for r in hot] + [tuple(r[1:]) for r in rows.where("conv_id = 1").collect()][3000:])


def test_many_equal_rows_are_counted_first(spark):
    rows = spark.range(20000).select(F.lit(5).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("user").alias("role"),
                                     F.lit("Again.").alias("text"))
    cut = R.segments(R._clean(rows)).collect()
    assert len(cut) == 1 and cut[0].kept == 20000 and cut[0].rows == 1
    got = R.repair(rows).first()
    assert (got.duplicate, got.illegal, got.cost) == (19999, 19999, 2 * 20000) and got.audit == "D" * 20000


def oracle(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/conversations.parquet{'' if 'sf' in path else '/*.parquet'}')")
    return con.sql(R.ORACLE).fetchall()


def test_query_with_nulls_repeats_and_clashing_names(spark, tmp_path):
    rng = random.Random(12)
    rows = [(c if rng.random() > 0.1 else None, t, *(x if rng.random() > 0.1 else None for x in r)) for c, t, *r in made(rng, 80)]
    rows += rows[:40] + [(500, 1, "user", None), (501, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("at", "copies", "part", "seen", "audit", "a.b"):
        df = df.withColumn(name, F.lit("x"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = R.op13_ida_star_repair(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is not None, r)
    assert sorted(map(tuple, got), key=key) == sorted(oracle(str(tmp_path)), key=key)
    assert any(r.audit == "" and r.repaired_sha256 == sha([]) for r in got)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert R.repair(R.damaged(empty)).count() == 0 and R.repaired_rows(empty).count() == 0


def test_very_long_texts(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y " * 2_000_000)], SCHEMA)
    got = R.repair(rows, max_bytes=1 << 20).first()
    assert (got.truncated, got.cost, got.audit) == (1, 4, "DD")


def test_query_matches_sql_at_sf001(spark):
    got = R.op13_ida_star_repair(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got)) == sorted(oracle("/root/testdata/sf0.01"))
