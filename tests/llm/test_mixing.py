import re

import pytest
from pyspark.sql import functions as F

from stormfare.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def targets(sizes):
    """Shares by weight, the excess above three times the size reshared until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest, w = total - sum(fixed.values()), sum(weights[s] for s in free)
        share = {s: rest * weights[s] / w for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 3.0 * sizes[s] for s in over})


@pytest.fixture(scope="module")
def rows():
    made = []
    for s, (source, count, words) in enumerate([("b", 400, 30), ("a", 10, 5), (None, 60, 20), ("ü", 300, 12), ("c", 90, 40)]):
        made += [(s * 1000 + i, " ".join(["w"] * (words + i % 17)), source) for i in range(count)]
    return made + [(9000, None, "b"), (9001, "", "a"), (9002, " \n", None)]


def test_targets_and_copies(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {r.doc_id: r for r in mixing.mixing_report(docs).collect()}
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    of = {}
    for i, _, s in rows:
        of[s] = of.get(s, 0) + size[i]
    wanted = targets(of)
    taken = dict.fromkeys(of, 0)
    for i, _, s in rows:
        r = found[i]
        assert (r["size"], r.source_size) == (size[i], of[s])
        assert r.target == pytest.approx(wanted[s])
        assert r.taken % max(size[i], 1) == 0 and r.taken <= 3 * size[i]
        taken[s] += r.taken
    for s in of:
        assert taken[s] == pytest.approx(wanted[s], abs=60, rel=0.01), s
    again = {r.doc_id: r.taken for r in mixing.mixing_report(docs.repartition(2)).collect()}
    assert again == {i: r.taken for i, r in found.items()}


def test_the_mix_has_every_copy(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"_size": F.lit("mine"), "target": F.col("doc_id")})
    report = {r.doc_id: r.taken // r["size"] for r in mixing.mixing_report(docs).filter("size > 0").collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    # The order within equal sizes is by id in both.
    assert counts == {i: n for i, n in report.items() if n}


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "s")] * 10 + [(None, "a b", "s")] * 2, SCHEMA)
    report = mixing.mixing_report(docs).collect()
    assert len(report) == 12 and sum(r.taken for r in report) == 24
    assert mixing.mixing_report(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None, "s"), (2, "", None)], SCHEMA)
    assert [(r["size"], r.target, r.taken) for r in mixing.mixing_report(nothing).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(nothing).count() == 0
