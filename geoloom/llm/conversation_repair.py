"""Conversation structure repair: the cheapest edits that make the roles of a conversation s?(ua)+ or nothing.

Conversations are dealt to tasks by a hash of their id and come in the order of their turns. In each batch a recursive
DuckDB query advances one turn of all conversations at a time; for each state of the grammar it keeps the least cost and,
of equal costs, the ASCII-least audit. Two audits of one state, place and cost never begin one another, since only an
insertion could make one longer and that costs more: so the least beginnings make the least audits. Long conversations are cut
into chunks that are walked side by side from every state and chained by a second recursion; what continues in the next
batch keeps, for each state, its cost, audit and running hash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.textvec import tidy

# What the edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Turns of a conversation that one walk takes; what follows is walked beside it from every state.
CHUNK = 64
#: States of the grammar: nothing yet, after a system turn, after a user's, after an assistant's. Conversations may end in
#: the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER_INSERT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: What ends a conversation in each state: cost and letters of the insertions.
ENDS = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
OK, BLANK, DUPLICATE, CUT_OFF = range(4)
SPACES = " \t\n\x0b\x0c\r"


def moves() -> list[tuple[int, str, int, int, int, str]]:
    """(state, initial, fault, next state, cost, letters): the best way over one turn, insertions before it included."""
    accepts = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
    best: dict[tuple, tuple[int, str]] = {}
    for begin in range(4):
        at = begin
        for inserted in range(3):
            cost, letters = INSERT * inserted, "I" * inserted
            for initial in ("s", "u", "a", ""):
                for fault in range(4):
                    ways = [(at, cost + DELETE, letters + "D")]
                    if fault in (OK, CUT_OFF):
                        left = cost + TRUNCATED * (fault == CUT_OFF)
                        if (at, initial) in accepts:
                            ways.append((accepts[at, initial], left, letters + "K"))
                        ways += [(accepts[at, to], left + REROLE, letters + "R") for to in "ua" if (at, to) in accepts]
                    for to, total, spelt in ways:
                        key = (begin, initial, fault, to)
                        best[key] = min(best.get(key, (total, spelt)), (total, spelt))
            at = AFTER_INSERT[at]
    return [(*key, *value) for key, value in sorted(best.items())]


#: turns (chunk, n, initial, fault) by n from 0, begins (chunk, origin), chain (part, k, chunk) by k from 0 ->
#: the best way of each part from each origin to each state.
WALK = """
WITH RECURSIVE walk(chunk, origin, n, state, best) AS (
    SELECT chunk, origin, 0::BIGINT, origin, {'cost': 0::BIGINT, 'audit': ''} FROM begins
    UNION ALL
    SELECT w.chunk, w.origin, w.n + 1, m.next, min({'cost': w.best.cost + m.cost, 'audit': w.best.audit || m.letters})
    FROM walk w JOIN turns t ON t.chunk = w.chunk AND t.n = w.n JOIN moves m ON m.state = w.state AND m.initial = t.initial AND m.fault = t.fault
    GROUP BY w.chunk, w.origin, w.n, m.next
), ways AS (
    SELECT w.* FROM walk w JOIN sizes s ON s.chunk = w.chunk AND s.n = w.n
), chained(part, origin, k, state, best) AS (
    SELECT c.part, w.origin, c.k, w.state, w.best FROM chain c JOIN ways w ON w.chunk = c.chunk WHERE c.k = 0
    UNION ALL
    SELECT d.part, d.origin, c.k, w.state, min({'cost': d.best.cost + w.best.cost, 'audit': d.best.audit || w.best.audit})
    FROM chained d JOIN chain c ON c.part = d.part AND c.k = d.k + 1 JOIN ways w ON w.chunk = c.chunk AND w.origin = d.state
    GROUP BY d.part, d.origin, c.k, w.state
)
SELECT d.part, d.origin, d.state, d.best.cost AS cost, d.best.audit AS audit
FROM chained d JOIN (SELECT part, max(k) AS k FROM chain GROUP BY part) e ON e.part = d.part AND e.k = d.k
"""


@dataclass
class Part:
    """A conversation as far as it has come: counts, and of each state cost, audit and the hash of the repaired lines."""

    id: pa.Array
    low: int | None = None
    high: int | None = None
    counts: np.ndarray = field(default_factory=lambda: np.zeros(5, np.int64))
    states: dict = field(default_factory=lambda: {START: (0, "", hashlib.sha256())})

    def row(self) -> tuple:
        cost, audit, state, _ = min((cost + ENDS[state][0], audit + ENDS[state][1], state, audit) for state, (cost, audit, _) in self.states.items())
        digest = self.states[state][2]
        for _ in ENDS[state][1]:
            digest.update(b"" if state == START else b"\n")
            state = AFTER_INSERT[state]
            digest.update(b"user:" if state == USER else b"assistant:")
        turns, *rest = self.counts.tolist()
        gaps = 0 if self.low is None else self.high - self.low + 1 - turns
        return (gaps if abs(gaps) < 1 << 63 else None, *rest, cost, audit, digest.hexdigest())


def lines(audit: str, state: int, roles: list[str], texts: list[str]) -> str:
    """What audit makes of turns after state: lines of role and text, with a line end before each but the first of all."""
    found = [] if state == START else [""]
    at = 0
    for letter in audit:
        user = state != USER
        if letter == "I":
            found.append("user:" if user else "assistant:")
        elif letter != "D":
            role = roles[at] if letter == "K" else "user" if user else "assistant"
            found.append(f"{role}:{texts[at]}")
        at += letter != "I"
        if letter == "K" and state == START and roles[at - 1][:1] == "s":
            state = SYSTEM
        elif letter != "D":
            state = USER if user else ASSISTANT
    return "\n".join(found)


def _advance(con, batch: pa.RecordBatch, part: np.ndarray, parts: dict[int, Part]) -> None:
    """Take the turns of a batch, whose conversations have these numbers, into parts."""
    there = ~batch.column("dropped").to_numpy(zero_copy_only=False)
    batch, part = batch.filter(pa.array(there)), part[there]
    if not len(part):
        return
    head = np.append(True, part[1:] != part[:-1])
    start = np.flatnonzero(head)
    since = np.arange(len(part)) - np.repeat(start, np.diff(np.append(start, len(part))))
    chunk = np.cumsum(head | (since % CHUNK == 0)) - 1
    first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
    fault = batch.column("fault").to_numpy()
    con.register("turns", pa.table({"chunk": chunk, "n": since % CHUNK, "initial": batch.column("initial"), "fault": fault}))
    con.register("sizes", pa.table({"chunk": chunk[first], "n": np.diff(np.append(first, len(part)))}))
    con.register("chain", pa.table({"part": part[first], "k": since[first] // CHUNK, "chunk": chunk[first]}))
    begins = [(c, s) for c, f, p in zip(chunk[first].tolist(), first.tolist(), part[first].tolist(), strict=True) for s in (parts[p].states if since[f] == 0 else range(4))]
    con.register("begins", pa.table({"chunk": [c for c, _ in begins], "origin": pa.array([s for _, s in begins], pa.int32())}))
    found: dict[int, list] = {}
    for p, origin, state, cost, audit in con.execute(WALK).fetchall():
        found.setdefault(p, []).append((origin, state, cost, audit))

    roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
    turn = batch.column("turn").to_pylist()
    sums = np.add.reduceat(np.stack([batch.column("new_turn").to_numpy(zero_copy_only=False).astype(np.int64), fault == BLANK, fault == DUPLICATE, fault == CUT_OFF, batch.column("illegal").to_numpy(zero_copy_only=False)], axis=1), start, axis=0, dtype=np.int64)
    for p, a, b, counts in zip(part[start].tolist(), start.tolist(), [*start[1:].tolist(), len(part)], sums, strict=True):
        own = parts[p]
        own.counts = own.counts + counts
        some = [t for t in turn[a:b] if t is not None]
        if some:  # in order
            own.low, own.high = some[0] if own.low is None else own.low, some[-1]
        best = {}
        for origin, state, cost, audit in found[p]:
            way = (own.states[origin][0] + cost, own.states[origin][1] + audit, origin, audit)
            best[state] = min(best.get(state, way), way)
        states = {}
        for state, (cost, whole, origin, audit) in best.items():
            digest = own.states[origin][2].copy()
            digest.update(lines(audit, origin, roles[a:b], texts[a:b]).encode())
            states[state] = (cost, whole, digest)
        own.states = states


def _rows(done: list[Part], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*(p.row() for p in done), strict=True))
    ids = pa.concat_arrays([p.id for p in done]).cast(id_type)
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    names = ["id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)


@tidy
def _repair(batches):
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
    names = ["state", "initial", "fault", "next", "cost", "letters"]
    con.register("moves", pa.table(dict(zip(names, zip(*moves(), strict=True), strict=True))))
    open_part: Part | None = None
    for batch in batches:
        if not len(batch):
            continue
        part = np.cumsum(batch.column("head").to_numpy(zero_copy_only=False))  # 0: goes on from the batch before
        heads = np.flatnonzero(batch.column("head").to_numpy(zero_copy_only=False))
        parts = {k + 1: Part(batch.column("id").slice(at, 1)) for k, at in enumerate(heads.tolist())}
        if open_part is not None:
            parts[0] = open_part
        _advance(con, batch, part, parts)
        last = int(part[-1])
        done = [parts[k] for k in sorted(parts) if k != last]
        open_part = parts[last]
        if done:
            yield _rows(done, batch.schema.field("id").type)
    if open_part is not None:
        yield _rows([open_part], open_part.id.type)
    con.close()


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, dropped): rows damaged by crc32 of "conv:turn" mod 20; nulls count as one space there and
    in role and text. 0 drops a row, which stays with dropped set so that its conversation is known; 1 empties the
    text; 2 takes its . ! ? away; 3 repeats the row; 4 makes the role user."""
    space = F.lit(" ")
    named = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), space).alias("role"), F.coalesce(F.col(text_col).cast("string"), space).alias("text"))
    kind = F.crc32(F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    marked = named.withColumn("kind", kind)
    lost = F.col("kind") == 0
    text = F.when(lost | (F.col("kind") == 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return marked.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), lost.alias("dropped"), F.explode(copies).alias("copy")).drop("copy")


def repair(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row for each conv of rows.

    rows have conv, turn, role, text and dropped, as damage() makes them; dropped rows only say that there is such a
    conversation, and one without other rows has zeros, no audit and the hash of the empty string. A null conv is a
    conversation; null roles and texts count as one space. Turns go by number, nulls first, then by role and text. gaps is
    null where it leaves the range of a long. All of a conversation is read by one task in batches, since its hash is one
    chain; what the task holds of it is a batch, four audits (a byte a turn each) and four hash states.
    """
    space = F.lit(" ")
    each = rows.select("conv", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), "dropped")
    each = each.repartition("conv")
    seen = Window.partitionBy("conv", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    order = Window.partitionBy("conv").orderBy("dropped", F.col("turn").asc_nulls_first(), "role", "text")
    trimmed = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    each = each.withColumn("again", F.row_number().over(seen) > 1)
    fault = F.when(trimmed == "", BLANK).when(F.col("again"), DUPLICATE).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), CUT_OFF).otherwise(OK)
    each = each.select("conv", "turn", "role", "text", "dropped", fault.cast("int").alias("fault"), initial.alias("initial"))
    before, earlier = F.lag("initial").over(order), F.lag("turn").over(order)
    each = each.select(
        F.col("conv").alias("id"), "turn", "role", "text", "dropped", "fault", F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("").alias("initial"),
        (F.row_number().over(order) == 1).alias("head"),
        F.coalesce(~F.concat(before, "initial").isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & ~earlier.eqNullSafe(F.col("turn"))).alias("new_turn"),
    )
    kind = each.schema["id"].dataType.simpleString()
    return each.mapInArrow(_repair, f"id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string").withColumnRenamed("id", "conv")


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, place, role, text, edit): the turns that audits, from repair(rows), make of rows, from place 1 on.

    Deleted turns are left out; inserted ones have an empty text.
    """
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    space = F.lit(" ")
    there = rows.where("NOT dropped").select("conv", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    there = there.withColumn("n", F.row_number().over(order))
    letters = audits.select("conv", F.posexplode(F.split("audit", "")).alias("k", "edit")).where("edit <> ''")
    upto = Window.partitionBy("conv").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    letters = letters.withColumn("n", F.sum((F.col("edit") != "I").cast("int")).over(upto)).withColumn("place", F.sum((F.col("edit") != "D").cast("int")).over(upto))
    left, right = letters.where("edit <> 'D'").alias("l"), there.alias("r")
    both = left.join(right, F.col("l.conv").eqNullSafe(F.col("r.conv")) & (F.col("l.n") == F.col("r.n")) & (F.col("l.edit") != "I"), "left")
    first = Window.partitionBy("l.conv")
    system = F.max(((F.col("place") == 1) & (F.col("edit") == "K") & F.col("role").startswith("s")).cast("int")).over(first)
    role = F.when(F.col("edit") == "K", F.col("role")).when((F.col("place") - system) % 2 == 1, "user").otherwise("assistant")
    return both.select(F.col("l.conv").alias("conv"), F.col("place").cast("long").alias("place"), role.alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit")


def repair_damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """repair() of what damage() makes of rows. An empty table gives an empty result; other columns are not read."""
    return repair(damage(rows, conv_col, turn_col, role_col, text_col)).withColumnRenamed("conv", conv_col)


def oracle() -> str:
    """DuckDB SQL for repair_damaged over the table conversations."""
    way = ", ".join(f"({a}, '{b}', {c}, {d})" for a, b, c, d in [(START, "s", SYSTEM, 0), (START, "u", USER, 0), (SYSTEM, "u", USER, 0), (ASSISTANT, "u", USER, 0), (USER, "a", ASSISTANT, 0)])
    return rf"""
WITH RECURSIVE crc AS MATERIALIZED (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), kinds AS (
    SELECT k.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed k, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM kinds, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
), placed AS (
    SELECT *, dense_rank() OVER (ORDER BY conv_id) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged
), faulty AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN {BLANK} WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 THEN {DUPLICATE}
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN {CUT_OFF} ELSE {OK} END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY c ORDER BY n) || left(role, 1) AS pair
    FROM placed
), ways(state, initial, next, extra) AS (VALUES {way}),
letters AS (
    SELECT state, initial, next, 0 AS cost, 'K' AS letter FROM ways
    UNION ALL SELECT state, i, next, {REROLE}, 'R' FROM ways, (VALUES ('s'), ('u'), ('a'), ('')) e(i) WHERE ways.initial <> 's'
), inserts(state, next, cost, spelt) AS (
    VALUES {", ".join(f"({s}, {t}, {c}, '{x}')" for s in range(4) for t, c, x in ((s, 0, ""), (AFTER_INSERT[s], INSERT, "I"), (AFTER_INSERT[AFTER_INSERT[s]], 2 * INSERT, "II")))}
), walk(c, n, state, best) AS (
    SELECT DISTINCT c, 0::BIGINT, 0, {{'cost': 0, 'audit': ''}} FROM faulty
    UNION ALL
    SELECT w.c, w.n + 1, o.next, min({{'cost': w.best.cost + i.cost + o.cost, 'audit': w.best.audit || i.spelt || o.letter}})
    FROM walk w JOIN faulty f ON f.c = w.c AND f.n = w.n + 1 JOIN inserts i ON i.state = w.state,
        LATERAL (SELECT i.next AS next, {DELETE} AS cost, 'D' AS letter
            UNION ALL SELECT l.next, l.cost + CASE WHEN f.fault = {CUT_OFF} THEN {TRUNCATED} ELSE 0 END, l.letter FROM letters l
            WHERE f.fault IN ({OK}, {CUT_OFF}) AND l.state = i.next AND l.initial = CASE WHEN left(f.role, 1) IN ('s', 'u', 'a') THEN left(f.role, 1) ELSE '' END) o
    GROUP BY w.c, w.n, o.next
), facts AS (
    SELECT c, any_value(conv_id) AS conv_id, count(*) AS turns, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = {BLANK}) AS blank,
        count(*) FILTER (WHERE fault = {DUPLICATE}) AS duplicate, count(*) FILTER (WHERE fault = {CUT_OFF}) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY c
), ended AS (
    SELECT w.c, min({{'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.spelt}}) AS best
    FROM walk w JOIN facts a ON a.c = w.c AND a.turns = w.n JOIN inserts i ON i.state = w.state WHERE i.next IN ({START}, {ASSISTANT}) GROUP BY w.c
), spelt AS (
    SELECT c, k, best.audit[k] AS letter, length(replace(left(best.audit, k), 'I', '')) AS n, length(replace(left(best.audit, k), 'D', '')) AS place
    FROM ended, LATERAL (SELECT unnest(range(1, length(best.audit) + 1)) AS k)
), joined AS (
    SELECT s.*, f.role, f.text, max(CASE WHEN place = 1 AND letter = 'K' AND f.role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.c) AS first
    FROM spelt s LEFT JOIN faulty f ON f.c = s.c AND f.n = s.n AND letter <> 'I' WHERE letter <> 'D'
), lined AS (
    SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - first) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS lines FROM joined GROUP BY c
), found AS (
    SELECT a.*, best.cost AS cost, best.audit AS audit, sha256(coalesce(lines, '')) AS repaired_sha256 FROM facts a JOIN ended USING (c) LEFT JOIN lined USING (c)
)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM i.conv_id
"""
