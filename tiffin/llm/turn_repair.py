"""Conversation structure repair by an auction algorithm for shortest paths.

A conversation's rows and what they may become form a lattice: node (i, state) stands for i rows used
and a repaired part that is empty, or ends in system, user or assistant. Arcs are the edits with
whole-number costs: Keep 0, Rerole 1, Delete 2, Insert an empty turn 5, and 5 more where a row that
breaks off is not deleted. Blank and repeated rows can only be deleted. The repaired roles must read
``(s?(ua)+)?``.

Nodes have prices that never exceed an arc's cost plus the price at its end. A path grows from an
origin: if the last node's price is below the best of its arcs, the price is raised to it and the
path gives the node up (contraction); else the best arc is tight and the path takes it (extension).
Nodes of the last row are auctioned first, a path ends where an earlier one has settled, and a row's
prices start at the least of the row after it, so the work is linear in the number of rows. All prices are then exact distances, every tight arc lies on a
cheapest repair, and the one whose edits read least in ASCII order is traced arc by arc.

Definitions. NULL role or text is one space, a NULL turn or conv_id one space where it is spelt out.
Rows are taken by turn (NULL first), then role and text, so ties and repeated rows have a fixed order
and copies are adjacent. Rows without a conv_id are one conversation. Empty text is blank. Only
conv_id, turn, role and text are read, so other columns cannot clash; an empty table gives no rows.

A conversation is handled by one task and comes out as one row with a letter per edit, so its texts
must fit in that task's memory and in a row (2 GB); measured in README.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import tidy
from tiffin.llm.trie_sql import crc32

KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 1, 2, 5, 5
FAULTS = 20                               # one row in so many gets each kind of damage
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # how the repaired part ends
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
        (USER, "a"): ASSISTANT}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
SHORT = 64                                # rows of conversations whose repair is remembered


# -- auction ------------------------------------------------------------------------------------


def arcs(row: str, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, rows used, next state) in ASCII order of edits. ``row`` is "" past the end, "-"
    for a row that must go, else its role's initial (" " if it has none that counts), followed by
    "!" if its text breaks off."""
    following = ASSISTANT if state == USER else USER
    if row:
        yield "D", DELETE, 1, state
    yield "I", INSERT, 0, following
    if row and row != "-":
        broken = BROKEN if row.endswith("!") else 0
        to = KEPT.get((state, row[0]))
        if to is not None:
            yield "K", KEEP + broken, 1, to
        yield "R", REROLE + broken, 1, following


def settle(rows: tuple[str, ...]) -> list[int]:
    """Exact prices (cost to the end) of all nodes, node (i, state) at 4 * i + state."""
    n = len(rows)
    price, settled = [0] * (4 * n + 5), [False] * (4 * n + 5)
    end = 4 * n + 4
    settled[end] = True

    def leaving(node: int) -> Iterator[tuple[int, int]]:
        i, state = divmod(node, 4)
        if i == n and state in (EMPTY, ASSISTANT):
            yield 0, end
        for _, cost, used, to in arcs(rows[i] if i < n else "", state):
            yield cost, 4 * (i + used) + to

    for origin in range(end - 1, -1, -1):
        i, state = divmod(origin, 4)
        if state == ASSISTANT and i < n:  # a row's nodes start as low as the row after them
            price[4 * i:4 * i + 4] = [min(price[4 * i + 4:4 * i + 8])] * 4
        path = [origin]
        while not settled[path[-1]]:
            last = path[-1]
            best, to = min((cost + price[v], v) for cost, v in leaving(last))
            if price[last] < best:
                price[last] = best
                if last != origin:
                    path.pop()
            else:
                path.append(to)
        for node in path:
            settled[node] = True
    return price


def cheapest(rows: tuple[str, ...]) -> tuple[int, str]:
    """Cost and edits of the cheapest repair, the least in ASCII order among ties."""
    price = settle(rows)
    i, state, edits = 0, EMPTY, []
    while i < len(rows) or state not in (EMPTY, ASSISTANT):
        for edit, cost, used, to in arcs(rows[i] if i < len(rows) else "", state):
            if price[4 * i + state] == cost + price[4 * (i + used) + to]:
                edits.append(edit)
                i, state = i + used, to
                break
    return price[EMPTY], "".join(edits)


_remembered = lru_cache(maxsize=1 << 16)(cheapest)


def repaired(turns: list[tuple[str, str]], edits: str) -> list[tuple[str, str]]:
    """The turns after the edits."""
    out, i, state = [], 0, EMPTY
    for edit in edits:
        if edit == "K":
            out.append(turns[i])
            state = KEPT[state, turns[i][0][:1]]
        elif edit != "D":
            state = ASSISTANT if state == USER else USER
            out.append((ROLE[state], turns[i][1] if edit == "R" else ""))
        i += edit != "I"
    return out


# -- conversations ------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage, which the checksum of ``conv_id:turn`` decides: a
    row is dropped, emptied, loses its ends of sentences, is repeated, or gets the role user.
    Dropped rows stay with ``gone`` set, so that their conversation is known."""
    def spelt(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spelt("conv_id"), F.lit(":"), spelt("turn")).cast("binary")) % FAULTS
    role, text = spelt("role"), spelt("text")
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"), (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("_copy")).drop("_copy")


FOUND = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
    ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])
FOUND_DDL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
             "cost long, audit string, repaired array<struct<role:string,text:string>>")


def judge(conv_id: int | None, rows: list[tuple[int | None, str, str]]) -> dict:
    """All results of one conversation; ``rows`` are (turn, role, text) in order."""
    count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    seen, kinds, before = set(), [], None
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        initial = role[:1] if role[:1] in ("s", "u", "a") else " "
        if not body:
            fault, kind = "blank", "-"
        elif (role, text) in seen:
            fault, kind = "duplicate", "-"
        elif body[-1] not in ".!?":
            fault, kind = "truncated", initial + "!"
        else:
            fault, kind = None, initial
        if fault:
            count[fault] += 1
        seen.add((role, text))
        kinds.append(kind)
        if before is not None:
            count["illegal"] += before + role[:1] not in LEGAL
        before = role[:1]
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = (_remembered if len(rows) <= SHORT else cheapest)(tuple(kinds))
    fixed = repaired([(r, t) for _, r, t in rows], audit)
    return {"conv_id": conv_id, **count, "cost": cost, "audit": audit,
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            "repaired": [{"role": r, "text": t} for r, t in fixed]}


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = object()
    conv, rows, out, held = nothing, [], [], 0
    for batch in batches:
        for c, turn, role, text, gone in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if c != conv:
                if conv is not nothing:
                    out.append(judge(conv, rows))
                if held > 4_000_000 or len(out) > 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema=FOUND)
                    out, held = [], 0
                conv, rows = c, []
            if not gone:
                rows.append((turn, role, text))
                held += len(text)
    if conv is not nothing:
        out.append(judge(conv, rows))
        yield pa.RecordBatch.from_pylist(out, schema=FOUND)


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the repaired turns of each conversation.

    ``rows`` has conv_id, turn, role and text, none of the last two NULL, and may have ``gone``.
    They are sorted in their task, not gathered in an array.
    """
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    sorted_rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role",
                              "text", gone.alias("gone")).repartition("conv_id") \
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_rows.mapInArrow(tidy(_judged), FOUND_DDL)


def digests(conversations: DataFrame) -> DataFrame:
    """Repair of damaged conversations, the repaired turns as a digest."""
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return repair(damage(conversations)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))


# -- comparison SQL -----------------------------------------------------------------------------


def _sql() -> str:
    def state(cost: str, audit: str, rows: str) -> str:
        return f"{{'c': CAST({cost} AS BIGINT), 'a': {audit}, 'r': {rows}}}"

    def insert(after: str, role: str) -> str:
        return state(f"{after}.c + 5", f"'I' || {after}.a", f"['{role}:'] || {after}.r")

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def used(own: str, follows: str, role: str, kept: dict[str, str]) -> str:
        """Best way to use the row: delete, rerole or keep."""
        extra = "CASE WHEN f.truncated THEN 5 ELSE 0 END"
        barred = "CASE WHEN f.gone THEN 1000000000 ELSE 0 END"
        options = [state(f"{own}.c + 2", f"'D' || {own}.a", f"{own}.r"),
                   state(f"{follows}.c + 1 + {extra} + {barred}", f"'R' || {follows}.a",
                         f"['{role}:' || f.text] || {follows}.r")]
        for initial, to in kept.items():
            wrong = f"CASE WHEN left(f.role, 1) = '{initial}' THEN 0 ELSE 1000000000 END"
            options.append(state(f"{to}.c + {extra} + {barred} + {wrong}", f"'K' || {to}.a",
                                 f"[f.role || ':' || f.text] || {to}.r"))
        return least(*options)
    done = state("0", "''", "CAST([] AS VARCHAR[])")
    spelt = "coalesce(CAST({} AS VARCHAR), ' ')"
    key = f"{spelt.format('conv_id')} || ':' || {spelt.format('turn')}"
    return rf"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role,
    coalesce(text, ' ') AS text, {crc32(key)} % 20 AS k FROM conversations),
e AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS again FROM k WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM e),
p AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
f AS (SELECT *, blank OR seen AS gone, cut AND NOT blank AND NOT seen AS truncated FROM p),
s AS (SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
    count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
z AS (SELECT {done} AS e, {insert(done, 'assistant')} AS u),
r AS (SELECT s.conv_id, s.n + 1 AS i, z.e AS e, {insert('z.u', 'user')} AS s, z.u AS u, z.e AS a
  FROM s, z
  UNION ALL SELECT conv_id, i, {least('e', insert('fu', 'user'))},
    {least('s', insert('fu', 'user'))}, fu, fa FROM (
    SELECT conv_id, i, e, s, {least('u', insert('a', 'assistant'))} AS fu,
      {least('a', insert('u', 'user'))} AS fa FROM (
      SELECT f.conv_id, f.i, {used('r.e', 'r.u', 'user', {'s': 'r.s', 'u': 'r.u'})} AS e,
        {used('r.s', 'r.u', 'user', {'u': 'r.u'})} AS s,
        {used('r.u', 'r.a', 'assistant', {'a': 'r.a'})} AS u,
        {used('r.a', 'r.u', 'user', {'u': 'r.u'})} AS a
      FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i - 1)))
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank,
  coalesce(s.duplicate, 0) AS duplicate, coalesce(s.truncated, 0) AS truncated,
  coalesce(s.illegal, 0) AS illegal, coalesce(r.e.c, 0) AS cost, coalesce(r.e.a, '') AS audit,
  sha256(coalesce(array_to_string(r.e.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = 1"""


SQL = _sql()
