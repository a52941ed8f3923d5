import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stormfare.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    found = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        found.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children),
                      len(leaves), saved, digest))
    return sorted(found, key=lambda r: r[:2])


def conversations(seed=3):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(205, 215), -3, -100, -101]:
        if c % 17 == 4:
            continue
        for turn in range(rng.choice([0, 1, 2, 3, 5, 6, 8])):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]),
                         rng.choice(["a", "é漢", "", None, f"own {c}"])))
    return [r for i, r in enumerate(rows) if r[1] is not None or not any(
        s[0] == r[0] and s[1] is None for s in rows[:i])]  # one null turn at most: their order is otherwise open


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("changes", [{}, {"RUN_TURNS": 2, "IDS_PER_PIECE": 2, "BROADCAST_ROWS": 0}])
def test_equals_brute_force(spark, monkeypatch, changes):
    for name, value in changes.items():
        monkeypatch.setattr(ct, name, value)
    rows = conversations() + [(None, 0, "user", "lost")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"conv": F.lit("x"), "depth": F.lit(1), "k1": F.lit(0), "run": F.lit(2), "chars": F.lit("y")})
    found = collected(ct.prefix_trie(df.repartition(3)))
    assert found == brute(rows)
    assert [r for r in found if r[1] == 0][0][2] is None


def test_a_long_conversation_copies_and_turnless_ones(spark, monkeypatch):
    """One conversation has most turns, many are equal, some are rebuilt without any turn."""
    monkeypatch.setattr(ct, "RUN_TURNS", 7)
    rows = [(1, t, "user", f"t{t % 3}") for t in range(60)] + [(7, t, "user", f"t{t % 3}") for t in range(53)]
    rows += [(c, 0, "user", "hello") for c in range(300, 340)] + [(c, 0, "user", "alone") for c in range(520, 530)]
    rows += [(300, 1, "assistant", "hi")]
    assert collected(ct.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert ct.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_are_turns_of_their_own(spark):
    rows = [(0, 1, "user", "x")] * 9 + [(50, 1, "user", "x")] * 7
    assert collected(ct.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


@pytest.mark.parametrize("weak", ["turn_keys", "multiplier"])
def test_shared_fingerprints_are_seen(spark, monkeypatch, weak):
    """The first seed hashes all turns alike, or forgets their order."""
    plain, tried = getattr(ct, weak), []

    def poor(seed):
        tried.append(seed)
        if seed:
            return plain(seed)
        return 1 if weak == "multiplier" else [F.lit(1).cast("long").alias("k1"), F.lit(1).cast("long").alias("k2")]

    monkeypatch.setattr(ct, weak, poor)
    headless = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 0]
    rows = [(c, t, "user", x) for c, words in zip(headless, ("abcdefgh", "abcdefhg", "badcfehg")) for t, x in enumerate(words)]
    assert collected(ct.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert set(tried) == {0, 1}
