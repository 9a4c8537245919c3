import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.llm import prefix_trie

TURNS = "conv_id long, turns array<struct<digest:string,size:int>>"
CHATS = "conv_id long, turn long, role string, text string"


def brute(convs: dict) -> set:
    """Nodes by a dictionary of all prefixes."""
    members, kids, out = {}, {}, set()
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def walk(p):
        leaves, saved = 0 if p in kids else 1, (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        for k in kids.get(p, []):
            a, b = walk(k)
            leaves, saved = leaves + a, saved + b
        ends = ",".join(str(c) for c in sorted(members[p]) if convs[c] == p)
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]),
                 len(kids.get(p, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved
    if members:
        walk(())
    return out


def frame(spark, convs: dict):
    rows = [(c, [(hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[:32], len(t))
                 for r, t in turns]) for c, turns in convs.items()]
    return spark.createDataFrame(rows, TURNS).repartition(4)


def drawn(seed: int, n: int) -> dict:
    rng = random.Random(seed)
    return {c: tuple((rng.choice("us"), rng.choice(["", "a", "bb", "cé"]))
                     for _ in range(rng.randrange(7))) for c in rng.sample(range(-50, 400), n)}


@pytest.mark.parametrize("rows,turns", [(1, 50), (3, 50), (7, 9), (1000, 50)])
def test_blocks_of_any_size_equal_brute_force(spark, rows, turns):
    """Stretches that cross blocks and tasks; groups of equal conversations larger than a block."""
    convs = drawn(rows, 200) | {1000 + i: (("u", "a"), ("s", "bb")) for i in range(40)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r)[:8] for r in prefix_trie.nodes(frame(spark, convs), rows, turns).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(set(got)) and set(got) == brute(convs)


def test_sparse_table_searches():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64):
        v = rng.integers(0, 5, n)
        t = prefix_trie.RangeMin(v)
        for i in range(n):
            for d in range(7):
                at, depth = np.array([i]), np.array([d])
                before = [j for j in range(i + 1) if v[j] < d]
                after = [j for j in range(i + 1, n) if v[j] < d]
                assert t.last_below(at, depth)[0] == (before[-1] if before else -1)
                assert t.first_below(at, depth)[0] == (after[0] if after else n)
            for j in range(i + 1, n + 1):
                assert t.minimum(np.array([i]), np.array([j]))[0] == v[i:j].min()


def test_rebuilding(spark):
    """A family's first turns replace own ones; shorter and absent firsts; ids below zero."""
    rows = [(c, t, "user", f"{c}.{t}") for c, n in ((0, 2), (7, 8), (9, 0), (213, 3), (-3, 2))
            for t in range(n)]
    turns = prefix_trie.turn_digests(spark.createDataFrame(rows, CHATS))
    got = {r["conv_id"]: r["n"] for r in prefix_trie.rebuilt(turns).select(
        "conv_id", F.size("turns").alias("n")).collect()}
    import zlib
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in (0, 7, 213, -3)}
    assert got == {0: 2, 7: min(h[7], 2) + 8 - h[7], 213: max(0, 3 - h[213]),
                   -3: min(h[-3], 2) + max(0, 2 - h[-3])}


def test_odd_rows(spark):
    """NULLs, ties, repeated rows, a conversation left without turns, clashing columns."""
    rows = [(100, 1, "b", "x"), (100, 1, "a", None), (100, None, None, "z"), (100, 1, "a", None),
            (None, 0, "user", "no conversation"), (307, 0, "user", "gone"), (400, 0, "u", "long " * 9999)]
    df = spark.createDataFrame(rows, CHATS).selectExpr(
        "*", "1 as depth", "2 as start", "3 as turns", "4 as digest")
    got = prefix_trie.trie(df).collect()
    by = {(r["conv_id"], r["depth"]): r for r in got}
    assert by[100, 0]["n_convs"] == 3 and by[100, 0]["parent_conv_id"] is None
    assert by[100, 4]["n_children"] == 0 and (100, 5) not in by
    order = prefix_trie.turn_digests(df).where("conv_id = 100").first()["turns"]
    assert [t["size"] for t in order] == [1, 0, 0, 1]
    assert prefix_trie.trie(spark.createDataFrame([], CHATS)).count() == 0


def test_a_long_conversation(spark):
    """One conversation of 100,000 turns, and a copy that ends early."""
    turns = [(hashlib.md5(str(i).encode()).hexdigest(), 1) for i in range(100_000)]
    df = spark.createDataFrame([(1, turns), (2, turns[:60_000])], TURNS)
    got = prefix_trie.nodes(df).agg(F.count("*").alias("n"), F.sum("n_convs").alias("m"),
                                    F.max("saved_tokens").alias("s")).first()
    assert tuple(got) == (100_001, 160_002, 60_000)
