import random
import zlib

import pytest
from pyspark.sql import functions as F

from stormfare.llm import toxicity


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        toxic = int(i % 8 == 0)
        text = [rng.choice(words) for _ in range(rng.randint(15, 60))]
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["zorkling", "quuxer", "zorkhead" + rng.choice("abcdef")]))
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    odd = [(2000, None), (2001, ""), (2002, "\n"), (2003, "abc " * 20_000), (2003, "abc " * 20_000)]
    return (spark.createDataFrame(docs + odd, "doc_id long, text string").withColumns({"toxic": F.lit(1), "score": F.lit("x")}),
            spark.createDataFrame(labels + [(2000, None), (None, 1), (0, 1)], "doc_id long, toxic int"), dict(labels))


@pytest.fixture(scope="module")
def rows(tables):
    return toxicity.toxicity(tables[0], tables[1]).collect()


def test_held_out_documents_are_told_apart(tables, rows):
    truth = tables[2]
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= toxicity.PREDICT_AT) for r in rows)


def test_every_document_has_a_score(tables, rows):
    assert len(rows) == tables[0].count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in by_id.values()) and {2000, 2001, 2002, 2003} <= set(by_id)
    assert by_id[2000] == by_id[2001] == by_id[2002]


def test_held_out_labels_are_never_read(spark, tables, rows):
    docs, labels, _ = tables
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.toxicity(docs, turned).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in again} == {(r.doc_id, round(r.score, 9)) for r in rows}


def test_without_both_labels_or_documents(spark, tables):
    docs, labels, _ = tables
    one = toxicity.toxicity(docs, labels.filter("toxic = 0"))
    assert {(r.score, r.predicted) for r in one.collect()} == {(0.0, 0)}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).count() == docs.count()
