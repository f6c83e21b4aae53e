"""Repair of damaged conversations: the cheapest edits that make the roles alternate.

A Viterbi pass over the rows of a conversation keeps, for every state, the cheapest edits that
lead there and, of equally cheap ones, the least in ASCII order.  The survivors' edits are paths
in a tree of back pointers with reference counts.  As soon as all survivors share an ancestor,
the edits up to it are final and leave the tree, so memory holds only what is still open; ties
are settled by comparing all that is open.

A long conversation is cut into chunks.  Each is solved for every state it may be entered in;
the cheapest ways through the chunks are found by the same survivors, with the edits of whole
chunks in place of single ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.ordering import GROUP, PLACE, numbered, text_key
from riskframe.llm.shared import table

CHUNK = 2_048  # rows of a conversation that are solved together
# What edits cost, and the states: nothing yet, after the system row, after a user's, after an assistant's.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
FINAL = (NOTHING, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INSERTS = [(NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)]
LEGAL = {"su", "ua", "au"}
# EXTRA[p][q]: whatever may follow q can follow p for at most so much more
EXTRA = {
    NOTHING: {SYSTEM: 0, USER: 2, ASSISTANT: 0},
    SYSTEM: {NOTHING: 4, USER: 2, ASSISTANT: 4},
    USER: {NOTHING: 5, SYSTEM: 2, ASSISTANT: 2},
    ASSISTANT: {NOTHING: 3, SYSTEM: 0, USER: 2},
}
BLANK, DUPLICATE, CUT, SOUND = "blank", "duplicate", "truncated", ""


def turned(state: int) -> int:
    """The state after a user's or an assistant's row, whichever is due."""
    return ASSISTANT if state == USER else USER


@cache
def moves(initial: str, fault: str) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edit) of all that may be done to a row."""
    found = [(s, s, DELETE, "D") for s in STATES]
    if fault in (BLANK, DUPLICATE):
        return found
    more = TRUNCATED if fault == CUT else 0
    for s in STATES:
        due = turned(s)
        found.append((s, due, REROLE + more, "R"))
        if initial == ROLES[due][0]:
            found.append((s, due, KEEP + more, "K"))
    if initial == "s":
        found.append((NOTHING, SYSTEM, KEEP + more, "K"))
    return found


class Node:
    """An edit, what it follows, and how many nodes and survivors hold it."""

    __slots__ = ("up", "edits", "payload", "refs")

    def __init__(self, up: Node | None, edits: str, payload: object):
        self.up, self.edits, self.payload, self.refs = up, edits, payload, 0
        if up:
            up.refs += 1


class Survivors:
    """The cheapest path to every state, in a tree that gives up what all of them share."""

    def __init__(self, entry: int, opening: bool):
        self.root = Node(None, "", None)
        self.best: dict[int, tuple[int, Node]] = {}
        self._take(self.best, entry, 0, self.root)
        if opening:
            self._insert(self.best)

    def _take(self, best: dict, state: int, cost: int, node: Node) -> None:
        node.refs += 1
        if state in best:
            self._drop(best[state][1])
        best[state] = (cost, node)

    def _drop(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node is not self.root:
            node = node.up
            node.refs -= 1

    def open_edits(self, node: Node) -> str:
        """All edits of a path that are not final."""
        parts = []
        while node is not self.root:
            parts.append(node.edits)
            node = node.up
        return "".join(reversed(parts))

    def _better(self, best: dict, state: int, cost: int, up: Node, edits: str) -> bool:
        if state not in best or cost < best[state][0]:
            return True
        return cost == best[state][0] and self.open_edits(up) + edits < self.open_edits(best[state][1])

    def _insert(self, best: dict) -> None:
        for _ in (1, 2):  # a user's row and an assistant's
            for a, b in INSERTS:
                if a in best and self._better(best, b, best[a][0] + INSERT, best[a][1], "I"):
                    self._take(best, b, best[a][0] + INSERT, Node(best[a][1], "I", None))

    def step(self, ways: Iterable[tuple], insert: bool) -> list[Node]:
        """Goes one row (or chunk) on by (from, to, cost, edits, payload ...); returns what became final, in order."""
        ahead: dict[int, tuple[int, Node]] = {}
        for a, b, cost, edits, *payload in ways:
            if a in self.best:
                before, node = self.best[a]
                if self._better(ahead, b, before + cost, node, edits):
                    self._take(ahead, b, before + cost, Node(node, edits, payload))
        if insert:
            self._insert(ahead)
        # what cannot win any more, whatever follows, holds up nothing
        for q in list(ahead):
            if any(p != q and ahead[p][0] + EXTRA[p][q] < ahead[q][0] for p in ahead):
                self._drop(ahead.pop(q)[1])
        for _, node in self.best.values():
            self._drop(node)
        self.best = ahead
        return self._settle()

    def _settle(self) -> list[Node]:
        """Moves the root to the last ancestor that all survivors share."""
        if self.root.refs != 1:
            return []
        _, node = next(iter(self.best.values()))
        path = []
        while node is not self.root:
            path.append(node)
            node = node.up
        final = []
        while path and self.root.refs == 1:
            self.root = path.pop()
            self.root.up = None
            final.append(self.root)
        return final

    def finish(self) -> list[Node]:
        """The rest of the cheapest path to a final state."""
        ends = [(self.best[s][0], self.open_edits(self.best[s][1]), s) for s in FINAL if s in self.best]
        node = self.best[min(ends)[2]][1]
        path = []
        while node is not self.root:
            path.append(node)
            node = node.up
        return path[::-1]


def ways_through(rows: list[tuple[str, str]], entry: int, opening: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, edits) of the cheapest ways through rows of (initial, fault)."""
    survivors, final = Survivors(entry, opening), []
    for initial, fault in rows:
        final += survivors.step(moves(initial, fault), True)
    shared = "".join(n.edits for n in final)
    return [(entry, s, cost, shared + survivors.open_edits(node)) for s, (cost, node) in survivors.best.items()]


WAYS = "array<struct<entry: int, exit: int, cost: long, edits: string>>"
CHUNKS = (
    f"{GROUP} string, chunk long, ways {WAYS}, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, turns long, low long, high long"
)
PLAN = (
    f"{GROUP} string, chunk long, entry int, edits string, cost long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long"
)


def _arrow(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    ways = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
    fields = [c.strip().split(" ", 1) for c in columns.replace(WAYS, "ways").split(", ")]
    return pa.schema([(name, kinds.get(kind, ways)) for name, kind in fields])


_ARROW = {CHUNKS: _arrow(CHUNKS), PLAN: _arrow(PLAN)}


def _solved(group: str, chunk: int, rows: list[tuple]) -> dict:
    """A chunk by itself: rows of (initial, fault, turn)."""
    kinds = [(initial, fault) for initial, fault, _ in rows]
    ways = [w for entry in (STATES if chunk else (NOTHING,)) for w in ways_through(kinds, entry, chunk == 0)]
    faults = [f for _, f in kinds]
    turns = [t for *_, t in rows if t is not None]
    return {
        GROUP: group,
        "chunk": chunk,
        "ways": [dict(zip(("entry", "exit", "cost", "edits"), w)) for w in ways],
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(CUT),
        "illegal": sum(a + b not in LEGAL for (a, _), (b, _) in zip(kinds, kinds[1:])),
        "first": kinds[0][0],
        "last": kinds[-1][0],
        "turns": len(set(turns)),
        "low": min(turns, default=None),
        "high": max(turns, default=None),
    }


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, chunk after chunk, to one row for each chunk."""
    at, rows, done = None, [], []
    for batch in batches:
        for g, c, initial, fault, turn in zip(*(batch.column(n).to_pylist() for n in (GROUP, "chunk", "initial", "fault", "turn"))):
            if (g, c) != at:
                if rows:
                    done.append(_solved(*at, rows))
                at, rows = (g, c), []
            rows.append((initial, fault, turn))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_ARROW[CHUNKS])
            done = []
    if rows:
        yield pa.RecordBatch.from_pylist([_solved(*at, rows)], schema=_ARROW[CHUNKS])


class _Course:
    """The chunks of one conversation in order."""

    def __init__(self):
        self.survivors, self.last, self.high = Survivors(NOTHING, False), None, None

    def add(self, chunk: dict) -> list[dict]:
        ways = chunk.pop("ways")
        chunk["illegal"] += self.last is not None and self.last + chunk.pop("first") not in LEGAL
        chunk.pop("first", None)
        self.last = chunk.pop("last")
        if chunk["turns"]:
            chunk["turns"] -= chunk["low"] == self.high
            self.high = chunk["high"]
        return self.told(self.survivors.step([(w["entry"], w["exit"], w["cost"], w["edits"], w, chunk) for w in ways], False))

    @staticmethod
    def told(nodes: list[Node]) -> list[dict]:
        return [{**chunk, "entry": way["entry"], "edits": way["edits"], "cost": way["cost"]} for way, chunk in (n.payload for n in nodes)]


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order, conversation after conversation, to the way taken through each."""
    at, course, done = None, None, []
    for batch in batches:
        for chunk in batch.to_pylist():
            if chunk[GROUP] != at:
                if course:
                    done += course.told(course.survivors.finish())
                at, course = chunk[GROUP], _Course()
            done += course.add(chunk)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_ARROW[PLAN])
            done = []
    if course:
        yield pa.RecordBatch.from_pylist(course.told(course.survivors.finish()), schema=_ARROW[PLAN])


REPAIRED = f"{GROUP} string, chunk long, step long, edit string, turn long, role string, text string"


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of a chunk (place -1), then its rows in order, to the repaired rows."""
    names = [c.strip().split(" ")[0] for c in REPAIRED.split(",")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    at, edits, step, state, out = None, "", 0, NOTHING, []

    def put(edit: str, turn: int | None, role: str, text: str | None) -> None:
        nonlocal step, state
        if edit in "IR":
            state = turned(state)
            role = ROLES[state]
        elif edit == "K":
            state = SYSTEM if state == NOTHING and role[:1] == "s" else turned(state)
        out.append((*at, step, edit, turn, role, text))
        step += 1

    def inserted() -> None:
        while step < len(edits) and edits[step] == "I":
            put("I", None, "", "")

    for batch in batches:
        for g, c, place, entry, told, turn, role, text in zip(*(batch.column(n).to_pylist() for n in (GROUP, "chunk", PLACE, "entry", "edits", "turn", "role", "text"))):
            if place < 0:
                inserted()  # at the end of the chunk before
                at, edits, step, state = (g, c), told, 0, entry
                continue
            inserted()
            put(edits[step], turn, role, text)
        if out:
            yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)
            out.clear()
    inserted()
    if out:
        yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)


def ordered(messages: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with their conversation as ``group`` and their place in it; nulls are one space."""
    filled = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = messages.select(
        text_key(F.col(f"`{conversation}`")).alias(GROUP), F.col(f"`{turn}`").cast("long").alias("turn"), filled(role).alias("role"), filled(text).alias("text")
    )
    return numbered(rows.withColumn("mark", F.sha2("text", 256)), ["turn", "role", "mark"], "dialogue-order").withColumn("chunk", F.floor(F.col(PLACE) / CHUNK))


def plan_repairs(rows: DataFrame) -> DataFrame:
    """The edits of every chunk of every conversation: entry (state), edits, cost, and counts of
    blank, duplicate and truncated rows, of illegal neighbours and of turns not seen before."""
    # the first of equal rows; one row each, so that the join meets every place once
    fresh = rows.groupBy(GROUP, "role", "mark").agg(F.min(PLACE).alias(PLACE)).select(GROUP, PLACE, F.lit(True).alias("fresh"))
    said = r"[^\x20\x09-\x0D]"
    light = rows.select(
        GROUP,
        PLACE,
        "chunk",
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(said)).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    ).join(fresh, [GROUP, PLACE], "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("fresh").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(SOUND)
    light = light.select(GROUP, "chunk", PLACE, "turn", "initial", fault.alias("fault"))
    chunks = light.repartition(GROUP, "chunk").sortWithinPartitions(GROUP, "chunk", PLACE).mapInArrow(_solve, CHUNKS)
    return chunks.repartition(GROUP).sortWithinPartitions(GROUP, "chunk").mapInArrow(_choose, PLAN)


def apply_repairs(rows: DataFrame, plan: DataFrame, whole: bool = False) -> DataFrame:
    """The repaired rows: group, chunk, step, edit, turn, role, text.  With ``whole`` a
    conversation's rows come one after the other, in order, within one partition."""
    none = lambda kind: F.lit(None).cast(kind)
    told = plan.select(GROUP, "chunk", F.lit(-1).cast("long").alias(PLACE), "entry", "edits", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"))
    held = rows.select(GROUP, "chunk", PLACE, none("int").alias("entry"), none("string").alias("edits"), "turn", "role", "text")
    dealt = told.unionByName(held).repartition(*([GROUP] if whole else [GROUP, "chunk"]))
    return dealt.sortWithinPartitions(GROUP, "chunk", PLACE).mapInArrow(_applied, REPAIRED)


def repair(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits of every conversation and the rows they leave.

    Returns conversation (as text), chunk and step (the order), edit (K keep, R new role, D
    delete, I insert), turn, role and text; rows with D are those to leave out.  Of all edits
    that leave an optional system row and then pairs of user and assistant, or nothing, these are
    the cheapest, and the least in ASCII order of those.

    Rows stand by turn, nulls first, then by role and text digest.  Null roles and texts are one
    space, a null conversation is one conversation (null in the result); a role counts by its
    initial.  Repeated rows are duplicates and go.  A long conversation is solved in chunks of
    2,048 rows by many tasks; only the ways through its chunks meet in one, and stream there.
    Long texts are no part of the search.  Other columns are harmless; an empty table gives an
    empty result.
    """
    rows = ordered(messages, conversation, turn, role, text)
    out = apply_repairs(rows, plan_repairs(rows))
    named = F.when(F.col(GROUP) != "-", F.substr(F.col(GROUP), F.lit(2)))
    return out.select(named.alias(conversation), "chunk", "step", "edit", "turn", "role", "text")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows, conversation after conversation, to its edits and the digest of what stays."""
    at, edits, sha, lines = None, [], hashlib.sha256(), 0
    done: list[tuple] = []

    def told() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(v, pa.string()) for v in zip(*done)], [GROUP, "audit", "repaired_sha256"])
        done.clear()
        return batch

    for batch in batches:
        for g, edit, role, text in zip(*(batch.column(n).to_pylist() for n in (GROUP, "edit", "role", "text"))):
            if g != at:
                if at is not None:
                    done.append((at, "".join(edits), sha.hexdigest()))
                at, edits, sha, lines = g, [], hashlib.sha256(), 0
            edits.append(edit)
            if edit != "D":
                sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        if done:
            yield told()
    if at is not None:
        done.append((at, "".join(edits), sha.hexdigest()))
        yield told()


def damaged(messages: DataFrame) -> DataFrame:
    """Conversations as op13 is to meet them: by a hash of conversation and turn rows are lost,
    emptied, cut, repeated or given to the user."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = messages.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), (F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20).alias("h"))
    text = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return dealt.where("h <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op13(spark, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "conversations")
    rows = ordered(damaged(messages), "conv_id", "turn", "role", "text")
    plan = plan_repairs(rows)
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    gaps = F.max("high") - F.min("low") + 1 - F.sum("turns")
    report = plan.groupBy(GROUP).agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in counts])
    digests = apply_repairs(rows, plan, whole=True).mapInArrow(_digests, f"{GROUP} string, audit string, repaired_sha256 string")
    every = messages.groupBy("conv_id").agg(F.lit(1)).select("conv_id", text_key(F.col("conv_id")).alias(GROUP))
    found = every.join(report, GROUP, "left").join(digests, GROUP, "left")
    return found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *counts)],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _sql() -> str:
    crc = (
        "xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(told, ''), lambda t: ord(t)::BIGINT), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"
    )
    # a way is eight digits of cost and its edits, so the least text is the way to take; one that is not there is null
    add = lambda way, cost, edit: f"lpad((substr({way}, 1, 8)::INT + {cost})::VARCHAR, 8, '0') || substr({way}, 9) || '{edit}'"
    may = lambda when, way: f"CASE WHEN {when} THEN {way} END"
    sound, more = "r.f NOT IN ('blank', 'duplicate')", "(r.f = 'truncated')::INT"
    into = {
        0: [],
        1: [may(f"{sound} AND r.i = 's'", add("a.s0", more, "K"))],
        2: [may(sound, add(f"a.s{s}", f"2 + {more}", "R")) for s in (0, 1, 3)] + [may(f"{sound} AND r.i = 'u'", add(f"a.s{s}", more, "K")) for s in (0, 1, 3)],
        3: [may(sound, add("a.s2", f"2 + {more}", "R")), may(f"{sound} AND r.i = 'a'", add("a.s2", more, "K"))],
    }
    row = ", ".join(f"s{s}: least({', '.join([add(f'a.s{s}', 3, 'D'), *into[s], 'NULL'])})" for s in into)
    user = f"least(n.s2, {add('n.s0', 2, 'I')}, {add('n.s1', 2, 'I')}, {add('n.s3', 2, 'I')})"
    bind = lambda value, name, then: f"list_transform([{value}], lambda {name}: {then})[1]"
    closed = bind(user, "u", "{" + f"i: r.i, f: r.f, s0: n.s0, s1: n.s1, s2: u, s3: least(n.s3, {add('u', 2, 'I')})" + "}")
    step = bind("{" + row + "}", "n", closed)
    return f"""
WITH told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS told FROM conversations),
dealt AS (SELECT *, {crc} % 20 AS h FROM told),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS p FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) AS k FROM placed),
judged AS (
  SELECT *, role[1] AS i, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN k > 1 THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS f
  FROM seen),
held AS (
  SELECT conv_id, count(*) FILTER (f = 'blank') AS blank, count(*) FILTER (f = 'duplicate') AS duplicate, count(*) FILTER (f = 'truncated') AS truncated,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         list({{i: i, f: f, s0: NULL::VARCHAR, s1: NULL::VARCHAR, s2: NULL::VARCHAR, s3: NULL::VARCHAR}} ORDER BY p) AS steps,
         list(role ORDER BY p) AS roles, list(text ORDER BY p) AS texts
  FROM judged GROUP BY conv_id),
solved AS (
  SELECT *, len(list_filter(range(1, len(steps)), lambda j: (steps[j].i || steps[j + 1].i) NOT IN ('su', 'ua', 'au'))) AS illegal,
         list_reduce([{{i: '', f: '', s0: '00000000', s1: NULL::VARCHAR, s2: '00000002I', s3: '00000004II'}}] || steps, lambda a, r: {step}) AS last
  FROM held),
taken AS (SELECT *, substr(least(last.s0, last.s3), 9) AS audit, substr(least(last.s0, last.s3), 1, 8)::BIGINT AS cost FROM solved),
opened AS (
  SELECT *, length(audit) - length(ltrim(audit, 'D')) + 1 AS head FROM taken),
lined AS (
  SELECT *, (audit[head] = 'K' AND steps[head].i = 's')::INT AS s FROM opened),
repaired AS (
  SELECT *, list_transform(list_filter(range(1, length(audit) + 1), lambda j: audit[j] <> 'D'),
    lambda j: CASE WHEN audit[j] = 'K' THEN roles[length(replace(audit[1:j], 'I', ''))]
                   WHEN (length(replace(audit[1:j], 'D', '')) - 1 - s) % 2 = 0 THEN 'user' ELSE 'assistant' END
              || ':' || CASE WHEN audit[j] = 'I' THEN '' ELSE texts[length(replace(audit[1:j], 'I', ''))] END) AS lines
  FROM lined)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""


QUERIES = {"op13_dialogue_repair": (op13, _sql())}
