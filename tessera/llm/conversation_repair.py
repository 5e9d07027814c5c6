"""Repair of conversation structure: the cheapest edits that make the roles ``system? (user assistant)+`` or nothing.

Rows of a conversation are blank, duplicate, truncated or sound.  An edit string deletes (``D``, 2), inserts an empty user or
assistant row (``I``, 5), keeps (``K``, 0) or gives a row the role that is due (``R``, 1); blank and duplicate rows must go, and a
truncated row that stays adds 5.  Iterative-deepening A* finds the ASCII-least of the cheapest strings: depth-first in the order
D, I, K, R under a bound on cost so far plus an admissible estimate, with a table of failed states that keeps
the cost still missing from each; the bound rises to the least cost that the table allows, and the first accepting path is
the answer.

Scale.  Rows are sorted by sampled ranges of (conversation, turn, role, text), so a conversation of any length spans several tasks,
and are cut into segments of at most ``SEGMENT_ROWS`` rows or ``SEGMENT_BYTES`` bytes; equal rows are counted before they are
shuffled.  A conversation in one segment is answered where it lies.  For one of several segments each segment yields the cheapest cost
from every state to every state, the costs to go are carried backwards over the segments, each segment is searched from each state
towards them, the chosen states are carried forwards, and the texts, hashed in order, are never held together.  Carrying
reads a conversation's segments in order in one task with a few numbers of memory.  That task alone depends on the length of a
conversation: a SHA-256 over all its rows, and one edit string for it, can only be made in order.

Defined cases: a null ``conv_id`` is a conversation like any other; a null role or text is one space; rows with null turns come first;
rows of equal turn are in order of role, then text; a repeated row is a duplicate; an empty table gives an empty result; texts
of any length are read whole; other columns are ignored; a conversation that lost all rows gets zeros, an empty audit and the hash of nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.operators.partitioning import partitions_for

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
DELETE, INSERT, REROLE, TRUNCATION = 2, 5, 1, 5
SEGMENT_ROWS = 256
SEGMENT_BYTES = 4 << 20
NEVER = 1 << 40
# States: nothing yet; after the system row; after a user row, which needs an answer; after an assistant row.
START, LED, ASKED, ANSWERED = range(4)
DUE = ("u", "u", "a", "u")  # what may come next; at the start "s" too
THEN = (ASKED, ASKED, ANSWERED, ASKED)
AT_END = (0, 2 * INSERT, INSERT, 0)  # cost of inserts after the last row
ROLE = {"u": "user", "a": "assistant"}


def fault_of(text: str, seen: bool) -> int:
    """The first fault of a row."""
    ink = text.rstrip(" \t\n\x0b\x0c\r")
    if not ink:
        return BLANK
    return DUPLICATE if seen else SOUND if ink[-1] in ".!?" else TRUNCATED


# ------------------------------------------------------------- the search
class Search:
    """Iterative-deepening A* over rows ``(role initial, fault)`` towards costs ``to_go`` of the states after the last row.

    ``last``: inserts may follow the last row and the end must be accepted; ``to_go`` is then not used.  The table ``short[i][s]``
    starts as the estimate (every blank or duplicate row still costs a delete, every truncated one at least as much)
    and holds, once a state failed, the least cost that its failure leaves possible.
    """

    def __init__(self, rows: list[tuple[str, int]], to_go: tuple[int, ...] = (0, 0, 0, 0), last: bool = True):
        self.rows, self.last, n = rows, last, len(rows)
        end = list(AT_END if last else to_go)
        self.short = [None] * n + [end]
        faults, least = 0, min(end)
        for i in range(n - 1, -1, -1):
            faults += DELETE if rows[i][1] else 0
            self.short[i] = [faults + least] * 4

    def _moves(self, i: int, s: int):
        """Edits at row ``i`` in state ``s`` in ASCII order: letter, cost, row and state after."""
        if i == len(self.rows):
            if self.last and AT_END[s]:
                yield "I", INSERT, i, THEN[s]
            return
        role, fault = self.rows[i]
        yield "D", DELETE, i + 1, s
        yield "I", INSERT, i, THEN[s]
        if fault in (BLANK, DUPLICATE):
            return
        extra = TRUNCATION if fault == TRUNCATED else 0
        if role == DUE[s]:
            yield "K", extra, i + 1, THEN[s]
        else:
            if s == START and role == "s":
                yield "K", extra, i + 1, LED
            yield "R", REROLE + extra, i + 1, THEN[s]

    def _dive(self, start: int, bound: int) -> str | None:
        """The first path from ``start`` in edit order whose cost is at most ``bound``; None, with a higher ``short``, if there is none."""
        short, n = self.short, len(self.rows)
        path: list[str] = []
        # frames: row, state, budget left, moves still to try, least cost seen to be possible
        stack = [[0, start, bound, self._moves(0, start), NEVER]]
        while stack:
            frame = stack[-1]
            i, s, left, moves, _ = frame
            if i == n and not (self.last and AT_END[s]):
                return "".join(path)
            for letter, cost, j, t in moves:
                need = cost + short[j][t]
                if need <= left:
                    path.append(letter)
                    stack.append([j, t, left - cost, self._moves(j, t), NEVER])
                    break
                frame[4] = min(frame[4], need)
            else:
                stack.pop()
                short[i][s] = max(short[i][s], frame[4])
                if stack:
                    above = stack[-1]
                    above[4] = min(above[4], above[2] - left + short[i][s])
                    path.pop()
        return None

    def best(self, start: int = START) -> tuple[int, str] | None:
        """Cost and the ASCII-least cheapest edits; None where no path ends."""
        bound = self.short[0][start]
        while bound < NEVER:
            found = self._dive(start, bound)
            if found is not None:
                return bound, found
            bound = self.short[0][start]
        return None


def walk(audit: str, roles: list[str], texts: list[str], s: int) -> tuple[int, list[tuple[str, str]]]:
    """State after the edits, and role and text of each repaired row."""
    lines, i = [], 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        due = DUE[s]
        if letter == "I":
            lines.append((ROLE[due], ""))
        else:
            lines.append((roles[i] if letter == "K" else ROLE[due], texts[i]))
        s = LED if letter == "K" and roles[i][:1] == "s" else THEN[s]
        i += letter != "I"
    return s, lines


def costs_between(rows: list[tuple[str, int]]) -> list[int]:
    """The cheapest cost from every state to every state over ``rows`` (16 numbers, row by row; ``NEVER``: no path)."""
    if not rows:
        return [0 if s == t else NEVER for s in range(4) for t in range(4)]
    out = []
    for s in range(4):
        for t in range(4):
            if t in (START, LED) and s != t and not (s == START and t == LED and any(r == "s" and f not in (BLANK, DUPLICATE) for r, f in rows)):
                out.append(NEVER)  # nothing leads back to the start, and only a kept system row leads behind it
                continue
            found = Search(rows, tuple(0 if x == t else NEVER for x in range(4)), last=False).best(s)
            out.append(NEVER if found is None else found[0])
    return out


# --------------------------------------------------------------- segments
ROW = "turn long, role string, text string, copies long"
SEGMENT_SCHEMA = "part int, number int, kept long, turns array<long>, roles array<string>, texts array<string>, copies array<long>, rows long"
RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one row with the sum of their copies."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["conv_id", "turn", "role", "text"]).aggregate([("copies", "sum")])
        yield from t.rename_columns(["conv_id", "turn", "role", "text", "copies"]).select(b.schema.names).to_batches()


def _segments_of(schema: pa.Schema, max_rows: int, max_bytes: int):
    """Sorted rows -> segments of one conversation each, numbered in order within the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        conv, key, number, size, weight = None, None, 0, 0, 0
        ready: list[dict] = []

        def close():
            nonlocal number, size, held
            if held:
                turns, roles, texts, copies = (list(x) for x in zip(*held))
                kept = sum(copies)
                if not kept:
                    turns, roles, texts, copies = [], [], [], []
                else:
                    live = [k for k, c in enumerate(copies) if c]
                    turns, roles, texts, copies = ([x[k] for k in live] for x in (turns, roles, texts, copies))
                ready.append({"conv_id": conv, "part": part, "number": number, "kept": kept, "turns": turns, "roles": roles, "texts": texts,
                              "copies": copies, "rows": len(copies)})
                number += 1
            held, size = [], 0

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies"))):
                if held and row[:4] == (conv, *held[-1][:3]):  # equal rows that were counted apart
                    held[-1] = (*held[-1][:3], held[-1][3] + row[4])
                    continue
                if held and (row[0] != conv or len(held) >= max_rows or size >= max_bytes):
                    close()
                conv = row[0]
                held.append(row[1:])
                size += len(row[3])
                weight += len(row[3])
            if weight > max_bytes or len(ready) > 4096:
                yield pa.RecordBatch.from_pylist(ready, schema)
                ready, weight = [], 0
        close()
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)
    return run


def _facts(segment: dict) -> tuple[list[tuple[str, int]], list[str], list[str], dict]:
    """Rows to search (copies after the first are duplicates), their roles and texts, and what the segment counts."""
    seen = set(segment["seen"] or ())
    rows, roles, texts, illegal = [], [], [], 0
    counts = [0] * 4
    before = None
    for role, text, copies in zip(segment["roles"], segment["texts"], segment["copies"]):
        same = f"{len(role)}:{role}{text}"
        known = same in seen
        seen.add(same)
        for k in range(copies):
            fault = fault_of(text, known or k > 0)
            counts[fault] += 1
            rows.append((role[:1], fault))
            roles.append(role)
            texts.append(text)
            if before is not None:
                illegal += before + role[:1] not in ("su", "ua", "au")
            before = role[:1]
    turns = {t for t in segment["turns"] if t is not None}
    facts = {"blank": counts[BLANK], "duplicate": counts[DUPLICATE], "truncated": counts[TRUNCATED], "illegal": illegal,
             "first_role": rows[0][0] if rows else None, "last_role": before, "least": min(turns, default=None), "most": max(turns, default=None),
             "distinct": len(turns)}
    return rows, roles, texts, facts


def _answer(f: dict, audit: str, digest: str) -> dict:
    return {"conv_id": f["conv_id"], "gaps": f["most"] - f["least"] + 1 - f["distinct"] if f["distinct"] else 0,
            **{c: f[c] for c in RESULT[1:]}, "audit": audit, "repaired_sha256": digest}


def _line(role: str, text: str) -> str:
    return f"{role}:{text}"


def _whole(segment: dict) -> dict:
    """The answer of a conversation that lies in one segment."""
    rows, roles, texts, f = _facts(segment | {"seen": None})
    cost, audit = Search(rows).best()
    repaired = walk(audit, roles, texts, START)[1]
    digest = hashlib.sha256("\n".join(_line(*r) for r in repaired).encode()).hexdigest()
    return _answer(f | {"conv_id": segment["conv_id"], "cost": cost}, audit, digest) | {"at": 0, "repaired": _rows(repaired)}


def _rows(repaired: list[tuple[str, str]]) -> list[dict]:
    return [{"role": r, "text": t} for r, t in repaired]


def _mapped(schema: pa.Schema, make):
    """One row out for each row in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([make(r) for r in b.to_pylist()], schema)
    return run


def _costs(segment: dict) -> dict:
    return {"conv_id": segment["conv_id"], "at": segment["at"], "costs": costs_between(_facts(segment)[0])}


def _carried_back(schema: pa.Schema):
    """Segments of a conversation from its last to its first -> the cost to go after each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, to_go = object(), AT_END
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["conv_id"] != conv:
                    conv, to_go = r["conv_id"], AT_END
                out.append({"conv_id": conv, "at": r["at"], "to_go": list(to_go)})
                to_go = [min(NEVER, *(r["costs"][4 * s + t] + to_go[t] for t in range(4))) for s in range(4)]
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _paths(segment: dict) -> dict:
    """From each state the edits of the segment on the best way to the end, and the state after them."""
    rows, roles, texts, _ = _facts(segment)
    audits, after = [], []
    for s in range(4):
        found = Search(rows, tuple(segment["to_go"]), last=segment["final"]).best(s)
        audits.append(found[1] if found else None)
        after.append(walk(found[1], roles, texts, s)[0] if found else START)
    return {"conv_id": segment["conv_id"], "at": segment["at"], "audits": audits, "after": after}


def _carried_on(schema: pa.Schema):
    """Segments of a conversation in order -> the state before each and its edits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, s = object(), START
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["conv_id"] != conv:
                    conv, s = r["conv_id"], START
                out.append({"conv_id": conv, "at": r["at"], "state": s, "edits": r["audits"][s]})
                s = r["after"][s]
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _repaired(segment: dict) -> dict:
    rows, roles, texts, facts = _facts(segment)
    lines = walk(segment["edits"], roles, texts, segment["state"])[1]
    cost = segment["edits"].count("D") * DELETE + segment["edits"].count("I") * INSERT + segment["edits"].count("R") * REROLE
    stay = [e for e in segment["edits"] if e != "I"]
    cost += TRUNCATION * sum(e != "D" and fault == TRUNCATED for e, (_, fault) in zip(stay, rows))
    return {"conv_id": segment["conv_id"], "at": segment["at"], **facts, "cost": cost, "audit": segment["edits"], "repaired": _rows(lines)}


def _joined(schema: pa.Schema):
    """Segments of a conversation in order -> its answer; the rows of one batch are held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if now is None or r["conv_id"] != now["conv_id"]:
                    if now is not None:
                        out.append(_answer(now, "".join(now["audit"]), now["sha"].hexdigest()))
                    now = {"conv_id": r["conv_id"], "least": None, "most": None, "distinct": 0, "last_role": None, "sha": hashlib.sha256(),
                           "lines": 0, "audit": [], **{c: 0 for c in RESULT[1:]}}
                for c in RESULT[1:]:
                    now[c] += r[c]
                if r["first_role"] is not None:
                    if now["last_role"] is not None:
                        now["illegal"] += now["last_role"] + r["first_role"] not in ("su", "ua", "au")
                    now["last_role"] = r["last_role"]
                if r["distinct"]:
                    now["distinct"] += r["distinct"] - (now["most"] == r["least"])
                    now["least"], now["most"] = r["least"] if now["least"] is None else now["least"], r["most"]
                now["audit"].append(r["audit"])
                for x in r["repaired"]:
                    now["sha"].update((("\n" if now["lines"] else "") + _line(x["role"], x["text"])).encode())
                    now["lines"] += 1
            yield pa.RecordBatch.from_pylist(out, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([_answer(now, "".join(now["audit"]), now["sha"].hexdigest())], schema)
    return run


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def segments(rows: DataFrame, max_rows: int = SEGMENT_ROWS, max_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Rows ``conv_id, turn, role, text, copies`` (0 copies: a row that is gone) as stored segments of whole order."""
    spark, kind = rows.sparkSession, dict(rows.dtypes)["conv_id"]
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    counted = rows.select("conv_id", "turn", "role", "text", "copies").mapInArrow(_counted, f"conv_id {kind}, {ROW}")
    ddl = f"conv_id {kind}, {SEGMENT_SCHEMA}"
    # the start of a text stands for it among the sampled bounds; equal rows meet in any case
    by = [order[0], order[1], "role", F.substring("text", 1, 64)]
    ranged = counted.repartitionByRange(partitions_for(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)
    return stored(ranged.sortWithinPartitions(*order).mapInArrow(_segments_of(_arrow(spark, ddl), max_rows, max_bytes), ddl), "segments")


REPAIRED = "repaired array<struct<role:string,text:string>>"


def _solved(rows: DataFrame, max_rows: int, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Conversations in one segment with their whole answer, and the solved segments of the others; both with ``at`` and ``repaired``."""
    spark, kind = rows.sparkSession, dict(rows.dtypes)["conv_id"]
    number = f"conv_id {kind}, at long"

    def through(df: DataFrame, ddl: str, make) -> DataFrame:
        return df.mapInArrow(_mapped(_arrow(spark, ddl), make), ddl)

    def carried(df: DataFrame, order, ddl: str, carry) -> DataFrame:
        return _in_order(df, order).mapInArrow(carry(_arrow(spark, ddl)), ddl)

    cut = segments(_clean(rows), max_rows, max_bytes)
    several = cut.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("c"), F.lit(True).alias("several"))
    marked = cut.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    whole = through(marked.where("several is null").drop("several"), f"{_result(kind)}, at long, {REPAIRED}", _whole)

    # conversations of several segments: for each segment its place and the rows that an earlier one holds too
    long = stored(marked.where("several").drop("several").withColumn("at", F.col("part").cast("long") * (1 << 32) + F.col("number")), "long")
    same = F.transform(F.arrays_zip("roles", "texts"), lambda z: F.concat(F.length(z["roles"]).cast("string"), F.lit(":"), z["roles"], z["texts"]))
    held = long.select("conv_id", "at", F.explode(F.array_distinct(same)).alias("same")).withColumn("digest", F.md5("same"))
    first = held.groupBy("conv_id", "digest").agg(F.min("at").alias("first"), F.max("at").alias("latest")).where("latest > first")
    again = (held.join(first.withColumnsRenamed({"conv_id": "c", "digest": "d"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
             .where("at > first").groupBy("conv_id", "at").agg(F.collect_set("same").alias("seen")))
    long = stored(_with(long, again), "long_seen")
    costs = through(long, f"{number}, costs array<long>", _costs)
    to_go = carried(costs, F.desc("at"), f"{number}, to_go array<long>", _carried_back)
    last = long.groupBy("conv_id").agg(F.max("at").alias("at")).withColumn("final", F.lit(True))
    ahead = _with(_with(long, to_go), last).withColumn("final", F.coalesce("final", F.lit(False)))
    paths = through(ahead, f"{number}, audits array<string>, after array<int>", _paths)
    chosen = carried(paths, F.asc("at"), f"{number}, state int, edits string", _carried_on)
    facts = ("blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, least long, most long, distinct long, "
             "cost long, audit string")
    return whole, through(_with(long, chosen), f"{number}, {facts}, {REPAIRED}", _repaired)


def _result(kind: str) -> str:
    return f"conv_id {kind}, " + ", ".join(f"{c} long" for c in RESULT) + ", audit string, repaired_sha256 string"


def repair(rows: DataFrame, max_rows: int = SEGMENT_ROWS, max_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row a conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``rows``: ``conv_id`` (of any type), ``turn long, role string, text string`` and optionally ``copies long``.
    """
    whole, parts = _solved(rows, max_rows, max_bytes)
    ddl = _result(dict(rows.dtypes)["conv_id"])
    joined = _in_order(parts, F.asc("at")).mapInArrow(_joined(_arrow(rows.sparkSession, ddl)), ddl)
    return whole.drop("at", "repaired").unionByName(joined)


def repaired_rows(rows: DataFrame, max_rows: int = SEGMENT_ROWS, max_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The repaired conversations: ``conv_id, at, number, role, text``, in order of ``at``, then ``number``."""
    whole, parts = _solved(rows, max_rows, max_bytes)
    both = whole.select("conv_id", "at", "repaired").unionByName(parts.select("conv_id", "at", "repaired"))
    return both.select("conv_id", "at", F.posexplode("repaired").alias("number", "r")).select("conv_id", "at", "number", "r.role", "r.text")


def _clean(rows: DataFrame) -> DataFrame:
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1).cast("long")
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"), copies.alias("copies"))


def _with(df: DataFrame, more: DataFrame) -> DataFrame:
    """``df`` with the columns of ``more`` for the same segment."""
    m = more.withColumnsRenamed({"conv_id": "c", "at": "a"})
    return df.join(m, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("a")), "left").drop("c", "a")


def _in_order(df: DataFrame, order) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", order)


# ------------------------------------------------------------------- query
def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32(``conv_id:turn``) mod 20; a dropped row stays as one of 0 copies."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(h == 4, F.lit("user")).otherwise(space("role")).alias("role"),
                                text.alias("text"), F.when(h == 0, 0).when(h == 3, 2).otherwise(1).cast("long").alias("copies"))


def op13_ida_star_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


# Fixed values of the SQL: the polynomial of CRC-32, and inserts (string, state after, cost, rows) before a row from each state.
ORACLE = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT))),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
  FROM conversations, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink
  FROM hurt),
faulty AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN ink = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(ink, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faulty GROUP BY conv_id),
inserts AS (SELECT * FROM (VALUES
  (0, '', 0, 0, CAST([] AS VARCHAR[])), (0, 'I', 2, 5, ['user:']), (0, 'II', 3, 10, ['user:', 'assistant:']),
  (1, '', 1, 0, CAST([] AS VARCHAR[])), (1, 'I', 2, 5, ['user:']), (1, 'II', 3, 10, ['user:', 'assistant:']),
  (2, '', 2, 0, CAST([] AS VARCHAR[])), (2, 'I', 3, 5, ['assistant:']),
  (3, '', 3, 0, CAST([] AS VARCHAR[])), (3, 'I', 2, 5, ['user:'])) v(s, edits, t, fee, made)),
edits AS (SELECT * FROM (VALUES ('D'), ('K'), ('S'), ('R')) v(e)),
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, {'cost': CAST(0 AS BIGINT), 'audit': '', 'made': CAST([] AS VARCHAR[])} AS best
  FROM counts
  UNION ALL
  SELECT conv_id, i, s, min(best) FROM (
    SELECT p.conv_id, f.i, CASE e WHEN 'D' THEN v.t WHEN 'S' THEN 1 ELSE CASE v.t WHEN 2 THEN 3 ELSE 2 END END AS s,
           {'cost': p.best.cost + v.fee + CASE WHEN e = 'D' THEN 2 ELSE CASE WHEN e = 'R' THEN 1 ELSE 0 END
                    + CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END END,
            'audit': p.best.audit || v.edits || CASE e WHEN 'S' THEN 'K' ELSE e END,
            'made': list_concat(list_concat(p.best.made, v.made), CASE WHEN e = 'D' THEN CAST([] AS VARCHAR[]) ELSE [
                      CASE WHEN e <> 'R' THEN f.role WHEN v.t = 2 THEN 'assistant' ELSE 'user' END || ':' || f.text] END)} AS best
    FROM paths p JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1 JOIN inserts v ON v.s = p.s CROSS JOIN edits
    WHERE e = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND
          ((e = 'K' AND f.r = CASE v.t WHEN 2 THEN 'a' ELSE 'u' END) OR (e = 'S' AND f.r = 's' AND v.t = 0) OR e = 'R'))) w
  GROUP BY conv_id, i, s),
ends AS (
  SELECT p.conv_id, min({'cost': p.best.cost + CASE s WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
                         'audit': p.best.audit || CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                         'made': list_concat(p.best.made, CASE s WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:']
                                             ELSE CAST([] AS VARCHAR[]) END)}) AS best
  FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i GROUP BY p.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""
