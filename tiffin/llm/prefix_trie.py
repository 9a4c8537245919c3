"""Prefix trie of conversations from sorted common prefixes and a sparse table of range minima.

Conversations are sorted by their turns, written as 128-bit digests. Between neighbours the length
of the common prefix (in turns) is known, and a prefix of depth d at row i belongs to the rows around
i as far as every common prefix on the way is d at least. Each candidate prefix finds both ends of
that stretch by itself, by binary search over a sparse table (minima of all runs of 2^k rows); there
is no stack and no order among candidates. Members, smallest member, parent and children follow from
the stretches and from prefix sums.

The sorted rows are cut into blocks of bounded size, so a hot prefix is spread over many tasks. A
block gives two staircases (where, seen from its left or right edge, the running minimum falls) of at
most one step per depth. The driver collects these, not the conversations, and builds a second sparse
table over blocks; with it each task knows the ends of the stretches that leave its block. Sums of
such stretches are partial rows, one per block, merged by a scan in order of blocks.

Definitions. Turns are ordered by turn (NULL first), then role and text. NULL role or text is empty.
Rows without a conv_id belong to no conversation. Repeated rows are turns like any other. Empty texts
count; very long ones enter as digest and length. Only conv_id, turn, role and text are read, so
other columns cannot clash. No conversation, no node.

A conversation's digests are one value, so a single one may have tens of millions of turns (20 bytes
each), not more; blocks and tasks are bounded otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import tidy
from tiffin.session import materialise

FAMILY, HEADS = 100, 6        # conversations of a family share a head of fewer than HEADS turns
BLOCK_ROWS, BLOCK_TURNS = 1 << 16, 1 << 20
DIGEST = 16
FAR = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()


class RangeMin:
    """Sparse table: the minimum of any run from two overlapping runs of a power of two."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        levels = max(1, self.n.bit_length())
        self.table = np.empty((levels, max(self.n, 1)), values.dtype)
        self.table[0, :self.n] = values
        for k in range(1, levels):
            half = 1 << (k - 1)
            self.table[k] = self.table[k - 1]
            self.table[k, :self.n - half] = np.minimum(self.table[k - 1, :self.n - half],
                                                       self.table[k - 1, half:self.n])

    def minimum(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of [low, high); an empty run has the largest number."""
        out = np.full(len(low), FAR, np.int64)
        some = np.flatnonzero(high > low)
        if len(some):
            a, b = low[some], high[some]
            k = np.frexp((b - a).astype(np.float64))[1] - 1
            out[some] = np.minimum(self.table[k, a], self.table[k, b - (1 << k.astype(np.int64))])
        return out

    def last_below(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to ``at`` whose value is below ``depth``, or -1."""
        end = at + 1
        for k in reversed(range(len(self.table))):
            to = end - (1 << k)
            step = (to >= 0) & (self.table[k, np.maximum(to, 0)] >= depth)
            end = np.where(step, to, end)
        return end - 1

    def first_below(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place after ``at`` whose value is below ``depth``, or the length."""
        start = at + 1
        for k in reversed(range(len(self.table))):
            to = start + (1 << k)
            step = (to <= self.n) & (
                self.table[k, np.minimum(start, max(self.n - 1, 0))] >= depth)
            start = np.where(step, to, start)
        return start


# -- conversations ------------------------------------------------------------------------------


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): per turn a digest of role and text, and the text's code points, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the role's length before it keeps ("a", "bc") and ("ab", "c") apart
    both = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        text.alias("text"), F.left(F.sha2(both, 256), F.lit(2 * DIGEST)).alias("digest"),
        F.char_length(text).alias("size"))
    gathered = materialise(rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "digest", "size"))).alias("turns")), "turns")
    # Texts travel only where two different turns of one number must be put in order.
    n = F.size("turns")
    neighbours = F.zip_with(F.slice("turns", 1, n - 1), F.slice("turns", 2, n - 1),
                            lambda a, b: a["turn"].eqNullSafe(b["turn"])
                            & (a["digest"] != b["digest"]))
    tied = materialise(gathered.where(F.exists(neighbours, lambda x: x)).select("conv_id"), "tied")
    if tied.isEmpty():
        return gathered
    full = rows.join(tied, "conv_id").groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "text", "digest", "size"))).alias("turns"))
    short = full.select("conv_id", F.transform("turns", lambda t: F.struct(
        t["turn"].alias("turn"), t["digest"].alias("digest"), t["size"].alias("size")))
        .alias("turns"))
    return gathered.join(tied, "conv_id", "left_anti").unionByName(short)


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Each conversation with the first turns of its family's first one in place of its own.

    The number of turns is the checksum of the id modulo ``heads``. A family's first conversation
    meets at most ``family`` others, so the join has no hot key.
    """
    first = turns.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, heads - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    joined = turns.join(first, F.col("conv_id") - F.col("conv_id") % family == F.col("_first"),
                        "left").withColumn("_h", h)
    head = F.when(F.col("_head").isNotNull(), F.slice("_head", F.lit(1), F.col("_h"))).otherwise(
        F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


# -- blocks of sorted conversations -------------------------------------------------------------

STAIRS = [(f"{side}_{what}", pa.list_(pa.int64())) for side in ("left", "right")
          for what in ("value", "place", "conv")]
BLOCK = pa.schema([
    ("slice", pa.int32()), ("block", pa.int32()), ("head", pa.int32()), ("n", pa.int64()),
    ("low", pa.int64()), ("first_key", pa.binary()), ("last_key", pa.binary()),
    ("convs", pa.list_(pa.int64())), ("depths", pa.list_(pa.int32())),
    ("common", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), *STAIRS])
BLOCK_DDL = ("slice int, block int, head int, n long, low long, first_key binary, last_key binary, "
             "convs array<long>, depths array<int>, common array<int>, sizes array<int>, "
             + ", ".join(f"{n} array<long>" for n, _ in STAIRS))


def common_prefixes(keys: list[bytes]) -> np.ndarray:
    """Turns that each key shares with the one before it; the first entry is 0."""
    out = np.zeros(len(keys), np.int32)
    if len(keys) < 2:
        return out
    size = np.fromiter((len(k) // DIGEST for k in keys), np.int64, len(keys))
    words = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    start = np.cumsum(size) - size
    both = np.minimum(size[1:], size[:-1])
    some = np.flatnonzero(both)
    if len(some):
        n = both[some]
        begin = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(begin, n)
        a = np.repeat(start[some], n) + step
        b = np.repeat(start[some + 1], n) + step
        differ = np.where((words[a] == words[b]).all(axis=1), np.repeat(n, n), step)
        out[some + 1] = np.minimum.reduceat(differ, begin)
    return out


def staircase(values: np.ndarray, convs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the running minimum of ``values`` falls: value, place, and the smallest conversation
    before that place."""
    low = np.minimum.accumulate(values) if len(values) else values
    place = np.flatnonzero(np.diff(low, prepend=FAR) < 0) if len(values) else np.zeros(0, np.int64)
    least = np.minimum.accumulate(np.concatenate([[FAR], convs]))
    return low[place].astype(np.int64), place, least[place]


def _pack(rows: int, turns: int):
    """Sorted rows of a task to blocks."""
    def block(part: int, number: int, keys: list, convs: list, sizes: list, before: bytes | None,
              last: bool) -> pa.RecordBatch:
        conv = np.array(convs, np.int64)
        common = common_prefixes(keys if before is None else [before, *keys])
        if before is not None:
            common = common[1:]
        # the first row's own value is joined by the reader, who knows the block before
        lv, lp, lc = staircase(common[1:], conv[1:])
        rv, rp, rc = staircase(common[:0:-1], conv[:0:-1])
        row = {
            "slice": part, "block": number, "head": None if before is None else int(common[0]),
            "n": len(keys), "low": int(conv.min()),
            "first_key": keys[0] if before is None else None, "last_key": keys[-1] if last else None,
            "convs": conv, "depths": [len(k) // DIGEST for k in keys], "common": common,
            "sizes": np.concatenate([np.zeros(0, np.int32), *sizes]).astype(np.int32),
            "left_value": lv, "left_place": lp + 1, "left_conv": np.minimum(lc, conv[0]),
            "right_value": rv, "right_place": len(keys) - 1 - rp, "right_conv": np.minimum(
                rc, conv[len(keys) - 1 - rp])}
        return pa.RecordBatch.from_pylist([row], schema=BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, None
        keys, convs, sizes, held = [], [], [], 0
        for batch in batches:
            size = batch.column("sizes")
            flat, bound = size.flatten().to_numpy(zero_copy_only=False), np.cumsum(
                [0] + [len(s) for s in size])
            for i, (key, conv) in enumerate(zip(batch.column("key").to_pylist(),
                                                batch.column("conv_id").to_pylist(), strict=True)):
                n = len(key) // DIGEST
                if keys and (len(keys) >= rows or held + n > turns):
                    yield block(part, number, keys, convs, sizes, before, False)
                    number, before = number + 1, keys[-1]
                    keys, convs, sizes, held = [], [], [], 0
                keys.append(key)
                convs.append(conv)
                sizes.append(flat[bound[i]:bound[i + 1]])
                held += n
        if keys:
            yield block(part, number, keys, convs, sizes, before, True)
    return tidy(run)


def blocks(rebuilt_turns: DataFrame, rows: int = BLOCK_ROWS, turns: int = BLOCK_TURNS) -> DataFrame:
    """Conversations sorted by their digests and conv_id, as one row per block."""
    keyed = rebuilt_turns.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias(
            "key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    return materialise(keyed.repartitionByRange("key", "conv_id")
                       .sortWithinPartitions("key", "conv_id")
                       .mapInArrow(_pack(rows, turns), BLOCK_DDL), "blocks")


# -- what lies beyond a block -------------------------------------------------------------------


@dataclass
class Overview:
    """All blocks in order: two staircases each, and sparse tables over their minima.

    One step per depth at most that reaches over a block's edge, so its size is bounded by blocks
    times the turns that neighbours share; a block stands for 65,536 conversations or a million turns.
    """
    index: dict[tuple[int, int], int]
    start: np.ndarray     # row number of each block's first row, and the number of all rows
    head: np.ndarray      # common prefix with the row before the block; -1 at both ends
    lows: RangeMin        # smallest common prefix in a block
    convs: RangeMin       # smallest conversation in a block
    left: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    right: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def collect(table: DataFrame) -> Overview:
        found = table.select("slice", "block", "head", "n", "low", "first_key", "last_key",
                             *[n for n, _ in STAIRS]).orderBy("slice", "block").collect()
        n = len(found)
        head, before = np.full(n + 1, -1, np.int64), None
        left, right = [], []
        for i, r in enumerate(found):
            if r["head"] is not None:
                head[i] = r["head"]
            elif i:
                head[i] = common_prefixes([before, bytes(r["first_key"])])[1]
            before = bytes(r["last_key"]) if r["last_key"] is not None else None
            left.append(Overview._join(r, "left", head[i], 0, FAR))
            right.append(Overview._join(r, "right", head[i], 0, r["low"], last=True))
        lows = np.array([s[0][-1] for s in left], np.int64)
        return Overview({(r["slice"], r["block"]): i for i, r in enumerate(found)},
                        np.cumsum([0] + [r["n"] for r in found]), head, RangeMin(lows),
                        RangeMin(np.array([r["low"] for r in found], np.int64)), left, right)

    @staticmethod
    def _join(row, side: str, head: int, place: int, conv: int, last: bool = False):
        """A staircase with the first row of the block, which is its first step or its last."""
        value, places, convs = (np.array(row[f"{side}_{w}"], np.int64)
                                for w in ("value", "place", "conv"))
        if last:
            keep = np.ones(len(value), bool)
            add = not len(value) or head < value[-1]
            parts = [[head] if add else [], [place] if add else [], [conv] if add else []]
            return tuple(np.concatenate([a[keep], np.array(b, np.int64)])
                         for a, b in zip((value, places, convs), parts, strict=True))
        keep = value < head
        return tuple(np.concatenate([np.array([b], np.int64), a[keep]])
                     for a, b in zip((value, places, convs), (head, place, conv), strict=True))

    def before(self, block: int, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per depth: first row of the stretch that enters ``block`` from the left, and the smallest
        conversation of the stretch before the block."""
        at = self.lows.last_below(np.full(len(depth), block - 1), depth)
        low = self.convs.minimum(at + 1, np.full(len(depth), block))
        return self._ends(self.right, at, depth, low)

    def after(self, block: int, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per depth: the row after the stretch that leaves ``block`` to the right, and the smallest
        conversation of the stretch behind the block."""
        at = self.lows.first_below(np.full(len(depth), block), depth)
        low = self.convs.minimum(np.full(len(depth), block + 1), at)
        return self._ends(self.left, at, depth, low)

    def _ends(self, stairs, at, depth, low) -> tuple[np.ndarray, np.ndarray]:
        row = np.empty(len(depth), np.int64)
        for k, (b, d) in enumerate(zip(at.tolist(), depth.tolist(), strict=True)):
            if b == len(stairs):  # nothing ends it: the last row does
                row[k] = self.start[-1]
                continue
            value, place, conv = stairs[b]
            step = np.searchsorted(-value, -d, side="right")
            row[k] = self.start[b] + place[step]
            low[k] = min(low[k], conv[step])
        return row, low


# -- nodes --------------------------------------------------------------------------------------

NODE = pa.schema([(n, pa.int64()) for n in (
    "start", "depth", "part", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
    "saved_tokens")] + [("ends", pa.string()), ("ends_sha256", pa.string())])
NODE_DDL = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in NODE)


def block_nodes(view: Overview, b: int, convs: np.ndarray, depths: np.ndarray, common: np.ndarray,
                sizes: np.ndarray) -> pa.RecordBatch:
    """The nodes that lie in one block, and the parts of those that reach beyond it (part is set)."""
    n = len(convs)
    common = common.astype(np.int64)
    common[0] = view.head[b]
    depths = depths.astype(np.int64)
    after = int(view.head[b + 1])
    # Candidates: at each row the prefixes that the row before does not share, and the longest it
    # does; at the block's first row all of them.
    first = common.copy()
    first[0] = 0
    count = depths - first + 1
    offset = np.cumsum(count) - count
    row = np.repeat(np.arange(n), count)
    depth = np.arange(len(row)) - offset[row] + first[row]
    table = RangeMin(common)
    left, right = table.last_below(row, depth), table.first_below(row, depth)
    open_left, open_right = left < 0, (right == n) & (depth <= after)
    start, end = view.start[b] + left, view.start[b] + right
    low = RangeMin(convs).minimum(np.maximum(left, 0), right)
    for opened, beyond, rows in ((open_left, view.before, start), (open_right, view.after, end)):
        if opened.any():
            known, back = np.unique(depth[opened], return_inverse=True)
            at, least = beyond(b, known)
            rows[opened] = at[back]
            low[opened] = np.minimum(low[opened], least[back])
    created = depth > common[row]
    n_convs = end - start
    turn_at = np.cumsum(depths) - depths
    size = np.zeros(len(row), np.int64)
    real = created & (depth > 0)
    size[real] = sizes[turn_at[row[real]] + depth[real] - 1]
    saved = np.where(created, (n_convs - 1) * size, 0)
    # a node's part in this block stands at the first row that has it
    stands = created | (row == 0)
    # children: each created node counts at its parent's place
    child = np.flatnonzero(real)
    above = child - 1
    moved = ~stands[above]
    top = np.maximum(left[above[moved]], 0)
    above[moved] = offset[top] + depth[above[moved]] - first[top]
    children = np.bincount(above, minlength=len(row))
    following = np.concatenate([common[1:], [after]])
    leaf = np.concatenate([[0], np.cumsum(following < depths)])
    total = np.concatenate([[0], np.cumsum(saved)])
    past = np.concatenate([offset, [len(row)]])  # candidate after the last row of a stretch
    subtree = total[past[right]] - total[np.arange(len(row))]
    same = np.zeros(n + 1, bool)
    same[1:n] = (common[1:] == depths[1:]) & (depths[1:] == depths[:-1])
    breaks = np.flatnonzero(~same)
    run_end = breaks[np.searchsorted(breaks, np.arange(n), side="right")] if n else breaks

    chosen = np.flatnonzero(stands)
    at, d = row[chosen], depth[chosen]
    part = open_left[chosen] | open_right[chosen]
    parent = np.where(d > 0, low[np.maximum(chosen - 1, 0)], 0)
    ends: list = [None] * len(chosen)
    digest: list = [None if p else NO_ENDS for p in part.tolist()]
    names = convs.astype(str)
    for k in np.flatnonzero(d == depths[at]).tolist():
        i = at[k]
        text = ",".join(names[i:run_end[i]])
        if part[k]:
            ends[k] = text
        else:
            digest[k] = hashlib.sha256(text.encode()).hexdigest()

    def longs(values, null=None):
        return pa.array(values, pa.int64(), mask=null)
    return pa.RecordBatch.from_arrays([
        longs(start[chosen]), longs(d), longs(np.full(len(chosen), b), ~part), longs(low[chosen]),
        longs(parent, (d == 0) | ~created[chosen]), longs(n_convs[chosen]),
        longs(children[chosen]), longs(leaf[right[chosen]] - leaf[at]), longs(subtree[chosen]),
        pa.array(ends, pa.string()), pa.array(digest, pa.string())], schema=NODE)


def _nodes(view: Overview):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block = view.index[batch.column("slice")[i].as_py(),
                                   batch.column("block")[i].as_py()]
                values = [batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                          for c in ("convs", "depths", "common", "sizes")]
                yield block_nodes(view, block, *values)
    return tidy(run)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of a node, in order of blocks, to one row; ids are hashed as they pass by."""
    node, out = None, []

    def close() -> None:
        if node is not None:
            out.append({**node, "ends": None, "part": None,
                        "ends_sha256": node["ends"].hexdigest()})
    for batch in batches:
        for r in batch.to_pylist():
            if node is None or (r["start"], r["depth"]) != (node["start"], node["depth"]):
                close()
                node = {**r, "ends": hashlib.sha256(), "some": False}
            else:
                for c in ("n_children", "n_leaves", "saved_tokens"):
                    node[c] += r[c]
                if node["parent_conv_id"] is None:
                    node["parent_conv_id"] = r["parent_conv_id"]
            if r["ends"] is not None:
                node["ends"].update((("," if node["some"] else "") + r["ends"]).encode())
                node["some"] = True
        if len(out) > 10_000:
            yield pa.RecordBatch.from_pylist(out, schema=NODE)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=NODE)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def nodes(rebuilt_turns: DataFrame, rows: int = BLOCK_ROWS, turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node of the trie, the root included.

    Input: conv_id (unique) and turns, an array of structs with a hex ``digest`` and a ``size``.
    Result: smallest member, depth, the parent's smallest member (NULL at the root), members,
    children, childless nodes of the subtree, the sum of (members - 1) * size over the subtree, a
    digest of the conversations that end here, and ``first_row``, the node's place in sorted order:
    its members are the ``n_convs`` conversations from there.
    """
    packed = blocks(rebuilt_turns, rows, turns)
    found = materialise(packed.mapInArrow(_nodes(Overview.collect(packed)), NODE_DDL), "nodes")
    merged = (found.where("part is not null").repartition("start", "depth")
              .sortWithinPartitions("start", "depth", "part").mapInArrow(tidy(_merge), NODE_DDL))
    return found.where("part is null").unionByName(merged).select(
        *COLUMNS, F.col("start").alias("first_row"))


def trie(conversations: DataFrame) -> DataFrame:
    """Nodes over rebuilt conversations; columns as in ``nodes`` without the place."""
    return nodes(rebuilt(turn_digests(conversations))).select(*COLUMNS)
