"""Conversation structure repair by depth-first branch and bound.

A conversation may only read ``(s?(ua)+)?``: at most one system turn first, then
user and assistant in turn.  Rows are kept, given another role, deleted, or
joined by inserted empty rows, as cheaply as possible; of equally cheap repairs
the one with the ASCII-least string of edits wins.

1. ``faults`` finds each row's place and first fault with window functions.
2. Each row becomes one letter.  Rows ``CHUNK`` letters long are searched by
   themselves from each state the rows before may end in (``search``: explicit
   stack, suffix lower bounds, incumbent, dominance table by row and state), so
   a conversation of any length is many small tasks.
3. ``chain`` streams over a conversation's chunks in order and joins their
   repairs; what it holds is the edit string, one byte a row.
4. Edits meet their rows in a join on (conversation, place).

Equal costs are compared by edit string.  For given rows before, state and cost
two repairs of a chunk can't be prefixes of one another (the longer would cost
more), so the ASCII-least whole is made of ASCII-least parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import materialize, shuffle_partitions

#: Rows searched as one piece.
CHUNK = 64

# Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Characters that count as blank.
BLANKS = " \t\n\x0b\x0c\r"

# States: nothing out yet, system out, user out, assistant out.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the next user or assistant turn.
TURN = (USER, USER, ASSISTANT, USER)
#: The most that one end state can be worth against another: after a user turn, an insertion and a system row deleted.
DETOUR = INSERT + DELETE
#: Edits as letters that also say the role: D, insert user I / assistant J, keep K, rerole to user R / assistant S.
#: Their order is that of D, I, K, R, as the role follows from the state.
INSERTED, REROLED = {USER: "I", ASSISTANT: "J"}, {USER: "R", ASSISTANT: "S"}


def moves(letter: str, state: int) -> list[tuple[int, str, int]]:
    """(cost, edit, next state) of the edits of one row; capital letters are truncated rows, ``d`` must go."""
    out = []
    if letter != "d":
        role, extra = letter.lower(), TRUNCATED * letter.isupper()
        turn = TURN[state]
        if role == "s" and state == START:
            out.append((extra, "K", SYSTEM))
        elif role == ("u" if turn == USER else "a"):
            out.append((extra, "K", turn))
        out.append((REROLE + extra, REROLED[turn], turn))
    out.append((DELETE, "D", state))
    return out


def suffix_bounds(letters: str) -> list[list[int]]:
    """[row][state]: least cost of the rows from there on, wherever they end; edit strings are left out of account."""
    bounds = [[0] * 4]
    for letter in reversed(letters):
        after = bounds[-1]
        own = [min(c + after[to] for c, _, to in moves(letter, s)) for s in range(4)]
        bounds.append([min(own[s], INSERT + own[TURN[s]], 2 * INSERT + own[TURN[TURN[s]]]) for s in range(4)])
    return bounds[::-1]


def search(letters: str, start: int) -> list[tuple[int, int, str]]:
    """(end state, cost, edits): the best repair from ``start`` to each end state that can matter.

    Depth first; on top of the stack lies the edit with the lowest cost and
    bound, of equal ones the ASCII-least.  A prefix is
    dropped if its row and state have a better (cost, edits) already, or if
    its cost and the bound of the rest exceed the incumbent by more than
    another end state can be worth.  The stack runs empty: what stands is
    optimal.
    """
    n, bounds = len(letters), suffix_bounds(letters)
    best: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]
    best[0][start] = (0, "")
    limit = float("inf")
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, edits = stack.pop()
        if best[i][state] != (cost, edits) or cost + bounds[i][state] > limit:
            continue
        if i == n:
            limit = min(limit, cost + DETOUR)
            continue
        turn = TURN[state]
        options = [(i + 1, to, cost + c, edits + e) for c, e, to in moves(letters[i], state)]
        options.append((i, turn, cost + INSERT, edits + INSERTED[turn]))
        for node in sorted(options, key=lambda o: (o[2] + bounds[o[0]][o[1]], o[3]), reverse=True):
            j, to, c, e = node
            if c + bounds[j][to] <= limit and (to not in best[j] or (c, e) < best[j][to]):
                best[j][to] = (c, e)
                stack.append(node)
    return [(end, c, e) for end, (c, e) in sorted(best[n].items()) if c <= limit]


def finish(state: int) -> str:
    """The insertions that end a conversation in ``state`` properly."""
    return {START: "", SYSTEM: "IJ", USER: "J", ASSISTANT: ""}[state]


def faults(turns: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` with place and first fault.

    ``(conv_id, turn, role, text, pos, fault, letter)``: rows in order of turn
    (null first), then role and text; ``fault`` is blank, duplicate, truncated
    or null; ``letter`` is the row as the search sees it.  Null roles and texts
    are one space.  A null ``conv_id`` is a conversation of its own.  Other
    columns are left out, so their names can't clash.
    """
    rows = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    place = [F.col("turn").asc_nulls_first(), "role", "text"]
    rows = rows.repartition("conv_id").withColumn(
        "pos", F.row_number().over(Window.partitionBy("conv_id").orderBy(*place)) - 1)
    same = Window.partitionBy("conv_id", F.xxhash64("role", "text"), "role", "text").orderBy("pos")
    rows = rows.withColumn("seen", F.row_number().over(same))
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = (F.when(last == "", "blank").when(F.col("seen") > 1, "duplicate")
             .when(~last.isin(".", "!", "?"), "truncated"))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return (rows.withColumn("fault", fault)
            .withColumn("letter", F.when(F.col("fault") == "truncated", F.upper(letter))
                        .when(F.col("fault").isNotNull(), "d").otherwise(letter))
            .drop("seen"))


_cached_search = lru_cache(maxsize=1 << 14)(search)


def _search_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for chunk, letters in zip(batch.column("chunk").to_pylist(), batch.column("letters").to_pylist(), strict=True):
            found.append([{"start": s, "end": end, "cost": c, "edits": e}
                          for s in (range(4) if chunk else (START,)) for end, c, e in _cached_search(letters, s)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("chunk"), pa.array(found, type=pa.list_(pa.struct(
                [("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])))],
            names=["conv_id", "chunk", "found"])


def chain(chunks: Iterator[tuple[int, list[dict]]]) -> list[tuple[int, int, str]]:
    """(chunk, cost, edits) of the best whole repair over a conversation's chunks in order."""
    heads = {START: (0, None)}  # state -> cost, chain of (chunk, cost, edits, chain before)

    def whole(link) -> tuple[str, ...]:
        parts = []
        while link is not None:
            parts.append(link[2])
            link = link[3]
        return tuple(reversed(parts))

    for chunk, found in chunks:
        after: dict[int, tuple] = {}
        for f in found:
            if f["start"] not in heads:
                continue
            cost, link = heads[f["start"]]
            made = (cost + f["cost"], (chunk, f["cost"], f["edits"], link))
            old = after.get(f["end"])
            if old is None or made[0] < old[0] or (made[0] == old[0] and _less(made[1], old[1])):
                after[f["end"]] = made
        heads = after
    ends = []
    for state, (cost, link) in heads.items():
        tail = finish(state)
        ends.append((cost + INSERT * len(tail), "".join(whole(link)) + tail, tail, link))
    _, _, tail, link = min(ends, key=lambda e: e[:2])
    out = []
    while link is not None:
        chunk, cost, edits, link = link
        out.append((chunk, cost + INSERT * len(tail), edits + tail))
        tail = ""
    return out[::-1]


def _less(a, b) -> bool:
    """Whether chain ``a`` spells an ASCII-lesser edit string than ``b``; both cover the same chunks."""
    differs = None
    while a is not b and a is not None:
        if a[2] != b[2]:
            differs = (a[2], b[2])  # the earliest difference is met last
        a, b = a[3], b[3]
    return differs is not None and differs[0] < differs[1]


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows) of batches sorted by conversation; rows must be used up before the next."""
    rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ["conv_id", *columns]), strict=True))
    row = next(rows, None)

    def of(key):
        nonlocal row
        while row is not None and row[0] == key:
            yield row[1:]
            row = next(rows, None)

    while row is not None:
        yield row[0], of(row[0])


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*some, strict=True), schema.types, strict=True)],
                                         schema=schema)


def _hashed(lines: Iterator[tuple[bytes]]) -> str:
    """SHA-256 of lines joined by newlines, one at a time."""
    sha = hashlib.sha256(next(lines)[0])
    for (line,) in lines:
        sha.update(b"\n" + line)
    return sha.hexdigest()


def _streamed(df: DataFrame, order: list[str], run: Callable, schema: str) -> DataFrame:
    """``run`` over a stated number of partitions that hold whole conversations in order, one after the other."""
    return df.repartition(shuffle_partitions(df.sparkSession), "conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, schema)


def repairs(rows: DataFrame) -> DataFrame:
    """(conv_id, chunk, cost, edits): the cheapest repair of each conversation of ``faults`` rows, in pieces."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]), "")
    # A stated number of partitions: letters are few bytes, but each is searched, so they must not be merged by size.
    pieces = (rows.select("conv_id", F.floor(F.col("pos") / CHUNK).cast("int").alias("chunk"), "pos", "letter")
              .repartition(shuffle_partitions(rows.sparkSession), "conv_id", "chunk")
              .groupBy("conv_id", "chunk").agg(letters.alias("letters")))
    found = pieces.mapInArrow(_search_chunks, f"conv_id {kind}, chunk int, "
                              "found array<struct<start: int, end: int, cost: bigint, edits: string>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(((key, *piece) for key, parts in _by_conversation(batches, ["chunk", "found"])
                             for piece in chain(parts)), made)

    made = pa.schema([("conv_id", _arrow(kind)), ("chunk", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])
    return _streamed(found, ["chunk"], run, f"conv_id {kind}, chunk int, cost bigint, edits string")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, pos, k, edit, role, text): what ``repairs`` leaves of ``faults`` rows, in order of (pos, k).

    ``edit`` is keep, rerole or insert; an inserted row has the place of the
    row that it precedes.  Deleted rows are left out.
    """
    units = found.select("conv_id", "chunk", F.posexplode(F.expr("regexp_extract_all(edits, '([IJ]*[DKRS]|[IJ]+$)', 1)"))
                         .alias("i", "unit"))
    units = units.select(F.col("conv_id").alias("c"), (F.col("chunk").cast("bigint") * CHUNK + F.col("i")).alias("p"), "unit")
    both = units.join(rows, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("p") == F.col("pos")), "left")
    edits = F.expr("transform(split(unit, ''), (e, k) -> struct(k, e))")
    return (both.select(F.col("c").alias("conv_id"), F.col("p").alias("pos"), "role", "text", F.inline(edits).alias("k", "e"))
            .filter("e NOT IN ('D', '')")
            .select("conv_id", "pos", "k",
                    F.when(F.col("e") == "K", "keep").when(F.col("e").isin("R", "S"), "rerole").otherwise("insert").alias("edit"),
                    F.when(F.col("e") == "K", F.col("role")).when(F.col("e").isin("I", "R"), "user").otherwise("assistant")
                    .alias("role"), F.when(F.col("e").isin("I", "J"), "").otherwise(F.col("text")).alias("text")))


def reports(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row a conversation: turn gaps, faults by kind, illegal neighbours, cost and edit string."""
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias
    before = F.lag(F.substring("role", 1, 1)).over(Window.partitionBy("conv_id").orderBy("pos"))
    pair = F.concat(before, F.substring("role", 1, 1))
    seen = rows.withColumn("pair", pair).groupBy("conv_id", "turn").agg(
        *[F.sum((F.col("fault") == k).cast("bigint")).alias(k) for k in ("blank", "duplicate", "truncated")],
        F.sum((~F.col("pair").isin("su", "ua", "au")).cast("bigint")).alias("illegal"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint")
    facts = seen.groupBy("conv_id").agg(gaps.alias("gaps"), *[count(F.col(c))(c) for c in (
        "blank", "duplicate", "truncated", "illegal")])
    audits = found.groupBy(F.col("conv_id").alias("c")).agg(
        F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("chunk", "edits"))).alias("parts"))
    audit = F.translate(F.array_join(F.transform("parts", lambda p: p["edits"]), ""), "JS", "IR")
    return (facts.join(audits, F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", audit.alias("audit")))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` lines joined by newlines, read through in order of (pos, k)."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(((key, _hashed(lines)) for key, lines in _by_conversation(batches, ["line"])),
                            pa.schema([("conv_id", _arrow(kind)), ("sha256", pa.string())]))

    lines = turns.select("conv_id", "pos", "k", F.concat_ws(":", "role", "text").cast("binary").alias("line"))
    return _streamed(lines, ["pos", "k"], run, f"conv_id {kind}, sha256 string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(reports, repaired turns)`` of a table with ``conv_id, turn, role, text``; either may be empty."""
    rows = materialize(faults(turns), "turns")
    found = materialize(repairs(rows), "repairs")
    return reports(rows, found), repaired_turns(rows, found)


def _oracle_sql() -> str:
    """The repair as a dynamic program in SQL: per conversation the best (cost, edits) of each state, row by row."""
    # A candidate is nine digits of cost and the edits, so that least() compares both.
    add = lambda v, c, e: f"printf('%09d', CAST(substr({v}, 1, 9) AS INT) + {c}) || substr({v}, 10) || {e}"
    gone = lambda v: add(v, DELETE, "'D'")
    stay = lambda v, role, keep, other: (
        f"CASE WHEN r.must THEN NULL WHEN r.i = '{role}' THEN {add(v, 'r.cut', repr(keep))} "
        f"ELSE {add(v, f'{REROLE} + r.cut', repr(other))} END")
    step = "xor(d >> 1, 3988292384 * (d & 1))"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)), "
           f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: {step})), 4294967295)")
    blank = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
dealt AS (SELECT *, {crc} % 20 AS m FROM given),
damaged AS (SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN m = 1 THEN '' WHEN m = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM dealt, unnest(CASE WHEN m = 3 THEN [1, 2] ELSE [1] END) WHERE m <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
    right(rtrim(text, {blank}), 1) AS tail FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM placed),
judged AS (SELECT *, left(role, 1) AS i, CASE WHEN tail = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
r AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CAST(fault = 'truncated' AS INT) AS cut FROM judged),
dp(conv_id, pos, v0, vs, vu, va) AS (
  SELECT conv_id, 0::BIGINT, '000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM (SELECT DISTINCT conv_id FROM given)
  UNION ALL
  SELECT d.conv_id, d.pos + 1, {gone("d.v0")},
    least({gone("d.vs")}, CASE WHEN NOT r.must AND r.i = 's' THEN {add("d.v0", "r.cut", "'K'")} END),
    least({gone("d.u")}, {stay("d.v0", "u", "K", "R")}, {stay("d.vs", "u", "K", "R")}, {stay("d.a", "u", "K", "R")}),
    least({gone("d.a")}, {stay("d.u", "a", "K", "S")})
  FROM (SELECT *, least(va, {add("u", INSERT, "'J'")}) AS a FROM (SELECT *, least(vu, {add("v0", INSERT, "'I'")},
      {add("vs", INSERT, "'I'")}, {add("va", INSERT, "'I'")}) AS u FROM dp)) d
  JOIN r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.pos = d.pos),
ends AS (SELECT conv_id, arg_max(least(v0, {add("vs", 2 * INSERT, "'IJ'")}, {add("vu", INSERT, "'J'")}, va), pos) AS v
  FROM dp GROUP BY conv_id),
units AS (SELECT conv_id, v, unnest(regexp_extract_all(substr(v, 10), '[IJ]*[DKRS]|[IJ]+$')) AS unit,
    generate_subscripts(regexp_extract_all(substr(v, 10), '[IJ]*[DKRS]|[IJ]+$'), 1) - 1 AS pos FROM ends),
lines AS (SELECT u.conv_id, string_agg(CASE e WHEN 'I' THEN 'user:' WHEN 'J' THEN 'assistant:' WHEN 'K' THEN r.role || ':' || r.text
    WHEN 'R' THEN 'user:' || r.text ELSE 'assistant:' || r.text END, chr(10) ORDER BY u.pos, place) AS whole
  FROM (SELECT *, unnest(string_split(unit, '')) AS e, generate_subscripts(string_split(unit, ''), 1) AS place FROM units) u
  LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM u.conv_id AND r.pos = u.pos WHERE e <> 'D' GROUP BY u.conv_id),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(substr(v, 1, 9) AS BIGINT) AS cost,
  translate(substr(v, 10), 'JS', 'IR') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM ends e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLE_SQL = _oracle_sql()
