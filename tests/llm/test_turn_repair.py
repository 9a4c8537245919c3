import hashlib
import heapq
import random
import re
import time

from tiffin.llm import turn_repair as repair

CHATS = "conv_id long, turn long, role string, text string"


def brute(rows: tuple[str, ...]) -> tuple[int, str]:
    """Cheapest edits by trying edit strings in order of cost, then of their letters."""
    heap, done = [(0, "", 0, "")], set()
    best = None
    while heap:
        cost, edits, i, roles = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best or (cost, edits), (cost, edits))
        if (edits, roles) in done or not re.fullmatch("s?(ua)*u?", roles):
            continue
        done.add((edits, roles))
        tail = roles[-1:]
        for c in "ua":
            if c != tail and (tail or c == "u"):
                heapq.heappush(heap, (cost + 5, edits + "I", i, roles + c))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, edits + "D", i + 1, roles))
            kind = rows[i]
            if kind != "-":
                extra = 5 if kind.endswith("!") else 0
                for c in "ua":
                    heapq.heappush(heap, (cost + 1 + extra, edits + "R", i + 1, roles + c))
                heapq.heappush(heap, (cost + extra, edits + "K", i + 1, roles + kind[0]))
    return best


def test_auction_equals_brute_force():
    rng = random.Random(3)
    kinds = ["s", "u", "a", " ", "-", "u!", "a!", "s!"]
    cases = [(), ("s",), ("a",), ("u", "u"), ("s", "s", "u", "a")]
    cases += [tuple(rng.choice(kinds) for _ in range(rng.randrange(1, 5))) for _ in range(150)]
    for rows in cases:
        assert repair.cheapest(rows) == brute(rows), rows


def test_prices_are_dual_feasible_and_tight():
    rng = random.Random(5)
    rows = tuple(rng.choice(["s", "u", "a", "-", "u!"]) for _ in range(60))
    price = repair.settle(rows)
    for i in range(len(rows) + 1):
        for state in range(4):
            out = [c + price[4 * (i + used) + to]
                   for _, c, used, to in repair.arcs(rows[i] if i < len(rows) else "", state)]
            if i == len(rows) and state in (repair.EMPTY, repair.ASSISTANT):
                assert price[4 * i + state] == 0
            else:
                assert price[4 * i + state] == min(out)


def test_work_is_linear():
    def seconds(n):
        start = time.process_time()
        repair.cheapest(("u", "a!", "u", "u", "-") * (n // 5))
        return time.process_time() - start
    seconds(1000)
    assert seconds(100_000) < 40 * max(seconds(10_000), 0.05)


def test_edits_give_legal_roles():
    rng = random.Random(7)
    for _ in range(300):
        turns = [(rng.choice(["system", "user", "assistant", " ", "tool"]), rng.choice(["x.", "y", ""]))
                 for _ in range(rng.randrange(9))]
        found = repair.judge(1, [(i, *t) for i, t in enumerate(turns)])
        roles = "".join(t["role"][0] for t in found["repaired"])
        assert re.fullmatch("(s?(ua)+)?", roles)
        assert sum(e in "KRD" for e in found["audit"]) == len(turns)


def one(rows):
    return repair.judge(1, rows)


def test_faults():
    got = one([(0, "user", "Hi."), (0, "user", "Hi."), (4, "assistant", " \t\n"), (2, "tool", "x"),
               (None, "assistant", "Yes! ")])
    assert (got["blank"], got["duplicate"], got["truncated"], got["gaps"]) == (1, 1, 1, 2)
    assert got["illegal"] == 3  # uu, at, ta
    assert (got["cost"], got["audit"]) == (6, "KDDDK")


def test_odd_rows(spark):
    """NULL ids, turns, roles and texts, repeated rows, all rows dropped, extra columns."""
    gone = next(c for c in range(1000) if _kind(c, 0) == 0)
    rows = [(None, None, None, None), (None, 1, "user", "a."), (gone, 0, "user", "dropped"),
            (5, 1, "user", "x."), (5, 1, "user", "x."), (5, None, "assistant", None)]
    df = spark.createDataFrame(rows, CHATS).selectExpr("*", "1 as gone", "2 as audit", "3 as cost")
    got = {r["conv_id"]: r for r in repair.digests(df).collect()}
    assert set(got) == {None, gone, 5}
    nothing = hashlib.sha256(b"").hexdigest()
    assert tuple(got[gone])[1:] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert got[5]["duplicate"] + got[5]["blank"] >= 2
    assert repair.digests(spark.createDataFrame([], CHATS)).collect() == []


def _kind(conv, turn):
    import zlib
    return zlib.crc32(f"{conv}:{turn}".encode()) % 20


def test_damage(spark):
    rows = [(c, 0, "assistant", "One. Two! Three? four") for c in range(200)]
    got = {}
    for r in repair.damage(spark.createDataFrame(rows, CHATS)).collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["gone"]))
    text = "One. Two! Three? four"
    for c in range(200):
        want = {0: [("assistant", "", True)], 1: [("assistant", "", False)],
                2: [("assistant", "One Two Three four", False)],
                3: [("assistant", text, False)] * 2, 4: [("user", text, False)]}
        assert got[c] == want.get(_kind(c, 0), [("assistant", text, False)])


def test_a_long_conversation(spark):
    rows = spark.range(50_000).selectExpr("1L as conv_id", "id as turn",
                                          "if(id % 3 = 0, 'user', 'assistant') as role",
                                          "concat('t', id, '.') as text")
    got = repair.digests(rows).first()
    assert got["cost"] > 0 and len(got["audit"]) >= 40_000
