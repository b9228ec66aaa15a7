"""Conversation structure repair: cheapest edits by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, state of the role order), the states
being: nothing yet (N), after a system row (S), after a user row (U) and
after an assistant row (A). Roles must read `(s?(ua)+)?`, so a path ends in N or A.
Edges: Keep, Rerole, Delete and Insert, with their costs. A forward heap from
the start and a reverse heap from the ends meet; all crossings of the cheapest
cost are finished, and the least audit (forward + edge + reverse) is taken.
In both directions nodes of equal cost leave the heap in the order of the edges of
cost 0 (Keep), so a node's least audit is known when it leaves.

Only a letter for each row reaches Python: who may keep it, whether it is truncated,
or that it must go. Rows are put in order by a range sort and cut into
blocks of at most `BLOCK` rows. A conversation within one block is searched from
start to end; of a longer one each block is searched for every pair of states,
and blocks are joined, `FAN` at a time, by the cheapest and then least
combination. So no task holds a long conversation's rows: what grows with it are its
audit, which is a value of the result, and the stream of its lines through SHA-256.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import numbered, read, written

#: Rows of a conversation that are searched at once, and blocks that are joined at once.
BLOCK, FAN = 256, 32
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

STATES = "NSUA"
ENDS = "NA"
#: State after a row or insertion with this initial.
AFTER = {"s": {"N": "S"}, "u": {"N": "U", "S": "U", "A": "U"}, "a": {"U": "A"}}
BEFORE = {i: {to: [q for q in STATES if moves.get(q) == to] for to in STATES} for i, moves in AFTER.items()}


def _edges(code: str, steps: dict, q: str) -> list[tuple[str, int, str]]:
    """(letter, cost, state) of the edges that consume a row of this code, from or into state q."""
    out = [("D", DELETE, q)]
    if code == "d":
        return out
    more, own = (TRUNCATED if code.isupper() else 0), code.lower()
    if own in AFTER:
        out += [("K", KEEP + more, x) for x in steps[own].get(q, [])]
    return out + [("R", REROLE + more, x) for i in "ua" for x in steps[i].get(q, [])]


def cheapest(codes: str, start: str = "N", ends: str = ENDS) -> tuple[int, str] | None:
    """Cost and audit of the cheapest, then least, edits of rows with these codes; None if there are none.

    A code is the initial of the row's role (x: none that may be kept), in upper case
    for a truncated row, or d for a row that must be deleted.
    """
    n = len(codes)
    source, sinks = (0, start), {(n, q) for q in ends}
    labels = [{source: (0, "")}, {s: (0, "") for s in sinks}]
    settled: list[set] = [set(), set()]
    heaps = [[(0, 0, start)], [(0, -n, q) for q in sorted(ends)]]
    best: tuple[int, str] | None = None

    def meet(left: tuple, letter: str, cost: int, right: tuple) -> None:
        nonlocal best
        (a, before), (b, after) = left, right
        found = (a + cost + b, before + letter + after)
        if best is None or found < best:
            best = found

    def edges(side: int, i: int, q: str):
        """Edges out of (side 0) or into (side 1) a node: letter, cost and the other node."""
        steps = AFTER if side == 0 else BEFORE
        for initial in "ua":
            for x in steps[initial].get(q, []):
                yield "I", INSERT, (i, x)
        row = i if side == 0 else i - 1
        if 0 <= row < n:
            for letter, cost, x in _edges(codes[row], steps, q):
                yield letter, cost, (i + 1 if side == 0 else i - 1, x)

    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, at, q = heapq.heappop(heaps[side])
        node = (abs(at), q)
        if node in settled[side] or labels[side][node][0] < cost:
            continue
        settled[side].add(node)
        own, other = labels[side][node][1], 1 - side
        if node in (sinks if side == 0 else {source}):
            meet((cost, own), "", 0, (0, ""))
        for letter, more, to in edges(side, *node):
            audit = own + letter if side == 0 else letter + own
            if to in settled[other] or to in (sinks if side == 0 else {source}):
                far = labels[other][to]
                meet(*(((cost, own), letter, more, far) if side == 0 else (far, letter, more, (cost, own))))
            old = labels[side].get(to)
            if old is None or (cost + more, audit) < old:
                labels[side][to] = (cost + more, audit)
                if old is None or cost + more < old[0]:
                    heapq.heappush(heaps[side], (cost + more, to[0] if side == 0 else -to[0], to[1]))
    return best


def plan(audit: str) -> str:
    """What becomes of rows: k kept, d deleted, u and a reroled; U and A are inserted rows.

    Roles alternate after the first; an odd number of rows is one that begins with a system row.
    """
    odd = (len(audit) - audit.count("D")) % 2
    out, place = [], 0
    for letter in audit:
        role = "ua"[(place - odd) % 2]
        out.append({"D": "d", "K": "k", "R": role, "I": role.upper()}[letter])
        place += letter != "D"
    return "".join(out)


def _illegal(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows after damage by their checksums; nulls as one blank."""
    blank = F.lit(" ")
    c = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"),
                             F.coalesce("text", blank).alias("text"),
                             F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                                      F.coalesce(F.col("turn").cast("string"), blank)).alias("name"))
    fault = F.crc32(F.encode("name", "UTF-8")) % 20
    return c.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), F.when(fault == 3, 2).otherwise(1).alias("copies"))


def _solved(blocks: DataFrame) -> DataFrame:
    """illegal, costs and audits of each block: start to end if it is whole, else for all pairs of states."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = lru_cache(20_000)(cheapest)  # of at most BLOCK letters each
        for batch in batches:
            rows = batch.select(["codes", "initials", "blocks"]).to_pylist()
            found = [[whole(r["codes"])] if r["blocks"] == 1 else
                     [cheapest(r["codes"], p, q) for p in STATES for q in STATES] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("start"), batch.column("block"), batch.column("blocks"),
                 pa.array([_illegal(r["initials"]) for r in rows], pa.int64()),
                 pa.array([r["initials"][0] for r in rows], pa.string()),
                 pa.array([r["initials"][-1] for r in rows], pa.string()),
                 pa.array([[f and f[0] for f in x] for x in found], pa.list_(pa.int64())),
                 pa.array([[f and f[1] for f in x] for x in found], pa.list_(pa.string()))],
                names=["start", "block", "blocks", "illegal", "head", "tail", "costs", "audits"])

    return blocks.mapInArrow(run, SOLVED)


SOLVED = ("start bigint, block bigint, blocks bigint, illegal bigint, head string, tail string, "
          "costs array<bigint>, audits array<string>")


def _join_blocks(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Consecutive blocks of a conversation as one: the cheapest, then least, for each pair of states."""
    rows = sorted(t.to_pylist(), key=lambda r: r["block"])
    table = lambda r: [None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])]
    out, found = rows[0], table(rows[0])
    for r in rows[1:]:
        step, n = table(r), len(STATES)
        found = [min(((a[0] + b[0], a[1] + b[1]) for q in range(n)
                      if (a := found[p * n + q]) and (b := step[q * n + to])), default=None)
                 for p in range(n) for to in range(n)]
        out["illegal"] += r["illegal"] + (out["tail"] + r["head"] not in LEGAL)
        out["tail"] = r["tail"]
    out["block"] = key[1].as_py()
    out["costs"], out["audits"] = [f and f[0] for f in found], [f and f[1] for f in found]
    return pa.Table.from_pylist([{c: out[c] for c in t.column_names}], t.schema)


def _hashes(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines (start, block, line or null), streamed in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, empty, done = None, None, True, []
        for batch in batches:
            for start, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if start != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest, empty = start, hashlib.sha256(), True
                if line is not None:
                    digest.update(line.encode() if empty else b"\n" + line.encode())
                    empty = False
            if done:
                yield pa.RecordBatch.from_pylist([{"start": a, "sha": b} for a, b in done])
                done = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"start": now, "sha": digest.hexdigest()}])

    return (lines.repartition("start").sortWithinPartitions("start", "block")
            .mapInArrow(run, "start bigint, sha string"))


def placed_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, copies), a row a copy, with their places ``at`` in the order of all."""
    keys = ["conv_id", "turn", "role", "text"]
    alike = rows.groupBy(*keys).agg(F.sum("copies").alias("n"))
    return numbered(alike.select(*keys, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")),
                    [*keys, "copy"], "at", "conversation-rows")


def judged(placed: DataFrame) -> DataFrame:
    """conv_id, at, turn, fault (or null), code and initial of each placed row."""
    ending = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    rows = placed.select("conv_id", "at", "turn", "role", F.sha2("text", 256).alias("digest"),
                         (ending == "").alias("blank"), (~F.substring(ending, -1, 1).isin(*".!?")).alias("open"),
                         F.when(initial.isin(*"sua"), initial).otherwise("x").alias("initial"))
    first = (rows.where(~F.col("blank")).groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
             .select("at", F.lit(True).alias("first")))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate")
             .when(F.col("open"), "truncated"))
    return rows.join(first, "at", "left").select(
        "conv_id", "at", "turn", "initial", fault.alias("fault"),
        F.when(fault.isin("blank", "duplicate"), "d").when(fault == "truncated", F.upper("initial"))
        .otherwise(F.col("initial")).alias("code"))


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, the figures, audit and SHA-256 of the repaired lines of each conversation of ``rows``."""
    placed = placed_rows(rows)
    judgements = written(judged(placed), "conversation-codes")
    block = F.floor(F.col("at") / BLOCK)
    count = lambda name: F.count(F.when(F.col("fault") == name, 1)).alias(name)
    per = judgements.groupBy("conv_id").agg(
        F.min("at").alias("start"), F.count("*").alias("n_rows"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *map(count, ("blank", "duplicate", "truncated")))
    per = written(per.withColumn("blocks", F.floor((F.col("start") + F.col("n_rows") - 1) / BLOCK)
                                 - F.floor(F.col("start") / BLOCK) + 1), "conversation-figures")
    inside = lambda c: F.array_join(F.transform(F.array_sort("rows"), lambda r: r[c]), "").alias(f"{c}s")
    blocks = (judgements.groupBy("conv_id", block.alias("block"))
              .agg(F.collect_list(F.struct("at", "code", "initial")).alias("rows"))  # at most BLOCK rows
              .select("conv_id", "block", inside("code"), inside("initial")))
    whose = per.select(F.col("conv_id").alias("_conv"), "start", "blocks")
    blocks = blocks.join(whose, blocks["conv_id"].eqNullSafe(whose["_conv"])).select(
        "start", "block", "blocks", "codes", "initials")
    solved = written(_solved(blocks), "conversation-blocks")
    whole = solved.where("blocks = 1")
    parts, left = solved.where("blocks > 1"), per.agg(F.max("blocks")).first()[0] or 1
    while left > 1:  # a block of the next level is FAN of this one; a conversation may begin inside one
        parts = written(parts.groupBy("start", F.floor(F.col("block") / FAN).alias("group"))
                        .applyInArrow(_join_blocks, SOLVED), "conversation-joins")
        left = parts.groupBy("start").count().agg(F.max("count")).first()[0] or 1
    ends = [STATES.index(q) for q in ENDS]
    options = F.array(*[F.struct(F.get("costs", F.lit(i)).alias("cost"), F.get("audits", F.lit(i)).alias("audit"))
                        for i in ends])
    chosen = lambda df, best: df.select("start", "illegal", best.alias("best"))
    best = chosen(whole, F.struct(F.get("costs", F.lit(0)).alias("cost"), F.get("audits", F.lit(0)).alias("audit"))
                  ).unionAll(chosen(parts, F.array_min(F.filter(options, lambda o: o.cost.isNotNull()))))
    best = written(best.select("start", "illegal", "best.cost", "best.audit"), "conversation-audits")
    as_plan = F.udf(plan, useArrow=False)
    pieces = best.select("start", F.posexplode(F.regexp_extract_all(
        as_plan("audit"), F.lit("[UA]*[kdua](?:[UA]+$)?"), F.lit(0))).alias("pos", "piece")).select(
        "start", (F.col("start") + F.col("pos")).alias("at"), "piece")
    said = lambda role: F.concat(role, F.lit(":"))
    line = lambda c: (F.when(c == "U", "user:").when(c == "A", "assistant:")
                      .when(c == "k", F.concat(said(F.col("role")), "text"))
                      .when(c == "u", F.concat(F.lit("user:"), "text"))
                      .when(c == "a", F.concat(F.lit("assistant:"), "text")))
    lines = placed.select("at", "role", "text").join(pieces, "at").select(
        "start", block.alias("block"), "at",
        F.filter(F.transform(F.split("piece", ""), line), lambda x: x.isNotNull()).alias("lines"))
    of_block = lines.groupBy("start", "block").agg(F.collect_list(F.struct("at", "lines")).alias("rows"))
    said_in = F.flatten(F.transform(F.array_sort("rows"), lambda r: r["lines"]))
    shas = _hashes(of_block.select("start", "block", F.when(F.size(said_in) > 0, F.array_join(said_in, "\n")).alias("line")))
    return per.join(best, "start").join(shas, "start").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha").alias("repaired_sha256"))


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``, whose rows are now ``rows`` (with their ``copies``).

    Rows go by turn, nulls first; ties by role, then text, then copy. Defined
    cases: a null conv_id is a conversation of its own; null roles and texts
    are one blank, so such a text is blank and such a role may not be kept;
    repeated rows are duplicates; a conversation without rows has zeros, an empty
    audit and the hash of the empty string; an empty table gives no rows. Texts
    may be of any length; other columns are not read.
    """
    ids = conversations.select(F.col("conv_id").alias("_conv")).distinct()
    found = repaired(rows)
    zero = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, ids["_conv"].eqNullSafe(found["conv_id"]), "left").select(
        F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in zero],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return repair(conversations, damaged(conversations))


def _oracle() -> str:
    """DuckDB SQL: a checksum by table, then one step of all states for each row of a conversation."""
    def add(state: str, cost: str, letter: str) -> str:
        return f"(lpad((substr({state}, 1, 9)::bigint + {cost})::varchar, 9, '0') || substr({state}, 10) || '{letter}')"

    def least(*options: str) -> str:
        return f"least({', '.join(options)})"

    def moved(to: str, initial: str, sources: list[str], own: str) -> str:
        keep = [f"CASE WHEN code = '{initial}' THEN {add(s, 'late', 'K')} END" for s in sources]
        role = [f"CASE WHEN code <> 'd' THEN {add(s, '3 + late', 'R')} END" for s in sources] if initial != "s" else []
        return f"{least(add(own, '4', 'D'), *keep, *role)} AS {to}"

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1
    THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t FROM (SELECT unnest(range(256)) AS n)),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS name FROM conversations),
summed AS (SELECT named.*, xor(4294967295, list_reduce(list_prepend(4294967295,
  list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::bigint)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS fault FROM named, crc_table),
rows_left AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
  CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM summed WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
  rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ending FROM rows_left),
judged AS (SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
  WHEN right(ending, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault, substr(role, 1, 1) AS initial FROM placed),
coded AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN initial IN ('s', 'u', 'a') THEN initial
  ELSE 'x' END AS code, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous FROM judged),
steps AS (
  SELECT DISTINCT conv_id, 0::bigint AS i, '000000000' AS n, NULL::varchar AS s, '000000003I' AS u, '000000006II' AS a FROM coded
  UNION ALL
  SELECT conv_id, i, n, s, u, {least('a', add('u', '3', 'I'))} AS a FROM (
    SELECT conv_id, i, n, s, {least('u', add('n', '3', 'I'), add('s', '3', 'I'), add('a', '3', 'I'))} AS u, a FROM (
      SELECT c.conv_id, c.i, {add('n', '4', 'D')} AS n, {moved('s', 's', ['n'], 's')},
        {moved('u', 'u', ['n', 's', 'a'], 'u')}, {moved('a', 'a', ['u'], 'a')}
      FROM steps p JOIN coded c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.i = p.i + 1))),
figures AS (SELECT conv_id, count(*) AS n_rows,
  coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::bigint AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM coded GROUP BY conv_id),
best AS (SELECT f.*, least(s.n, s.a) AS found FROM figures f
  JOIN steps s ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.n_rows),
letters AS (SELECT conv_id, j, substr(audit, j, 1) AS letter, audit FROM (
  SELECT conv_id, substr(found, 10) AS audit, unnest(range(1, length(found) - 8)) AS j FROM best)),
counted AS (SELECT *, count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS place,
  count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i,
  count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM letters),
lines AS (SELECT l.conv_id, l.j, CASE letter WHEN 'K' THEN c.role || ':' || c.text
  WHEN 'R' THEN l.own || ':' || c.text ELSE l.own || ':' END AS line FROM (
    SELECT *, CASE WHEN (place - 1 + odd) % 2 = 0 THEN 'user' ELSE 'assistant' END AS own FROM counted) l
  LEFT JOIN coded c ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND c.i = l.i AND l.letter <> 'I' WHERE letter <> 'D'),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS repaired FROM lines GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(substr(found, 1, 9)::bigint, 0) AS cost, coalesce(substr(found, 10), '') AS audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM ids LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


SQL = _oracle()
