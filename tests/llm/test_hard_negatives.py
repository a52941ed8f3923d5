import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormfare.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    usable = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows
              if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    found = []
    for a, label, q in usable:
        if a % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(q, p)), i, m) for i, m, p in usable if i != a and len(p) == len(q)]
        scored.sort(key=lambda s: s[:2])
        for ps, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 50 * -ps <= 100 * -s[0] <= 95 * -ps][:3]
            found += [(a, positive, k + 1, i, -ps, -s) for k, (s, i, _) in enumerate(inside)]
    return sorted(found)


def vectors(n=600, size=8, seed=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, size))
    rows = []
    for i in range(n):
        v = centers[rng.integers(12)] + rng.normal(size=size) * rng.choice([0.05, 0.4])
        rows.append((int(i), np.round(v, 2).tolist(), int(rng.integers(4))))
    rows += [(2_000 + i, rows[0][1], i % 2) for i in range(60)]  # one vector many times: ties
    return rows


@pytest.mark.parametrize("changes", [{}, {"TREE_ANCHORS": 3, "BLOCK_ROWS": 40, "RANGE_ANCHORS": 5}])
def test_equals_brute_force(spark, monkeypatch, changes):
    for name, value in changes.items():
        monkeypatch.setattr(hn, name, value)
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit("x"), "block": F.lit(1), "tree": F.lit(2)})
    found = sorted(tuple(r) for r in hn.hard_negatives(df.repartition(3)).collect())
    assert found == brute(rows) and len(found) > 100


def test_odd_rows_and_repeated_ones(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(200, 3) + vectors(3, 3)
    odd = [None, [nan, 1.0, 0.0], [1.0, None, 0.0], [inf, 1.0, 0.0], [], [0.0, 0.0, 0.0], [1.0, 0.5], [0.5, 0.5], [0.6, 0.4]]
    rows += [(50 * (100 + i), v, i % 2) for i, v in enumerate(odd)] + [(None, [1.0, 1.0, 1.0], 1), (10_000, [0.1, 0.1, 0.2], None)]
    rows += [(50, [0.3, 0.2, 0.9], 1), (50, [0.3, 0.2, 0.9], 1)]  # an anchor's id again, twice, with other content
    found = sorted(tuple(r) for r in hn.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == brute(rows)
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="too large"):
        hn.hard_negatives(spark.createDataFrame([(50, [1e6], 1), (51, [1.0], 1)], SCHEMA)).count()


def test_bounds_hold_and_spare_scores(monkeypatch):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(10, 16)) * 100
    x = np.floor(np.repeat(centers, 100, axis=0) + rng.normal(size=(1000, 16)) * 4)
    block = hn.Block({"ids": list(range(1000)), "labels": [i % 3 for i in range(1000)], "rows": list(range(1000)),
                      "size": 16, "vectors": x.astype("<i4").tobytes()})
    own = x[::20]
    order, parent, edges = hn.spanning_tree(own)
    place = np.argsort(order)
    tree = {"n": len(own), "size": 16, "vectors": own[order].tobytes(), "edges": edges[order].tolist(),
            "parents": np.where(parent[order] < 0, -1, place[parent[order]]).tolist()}
    assert all(p < i for i, p in enumerate(tree["parents"]))
    walk = hn.Walk(block, tree)
    for i in range(len(own)):
        low, high = walk.bounds(i)
        exact = x @ own[order][i]
        assert (low <= exact).all() and (exact <= high).all()
        walk.score(i, low, high, np.argsort(-high)[:50])
        walk.keep(i, low, high)
    assert walk.scored < 0.2 * len(own) * len(x)
    assert not walk.held
