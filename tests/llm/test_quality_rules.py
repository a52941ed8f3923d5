import random
import re

import pytest
from pyspark.sql import functions as F

from stormfare.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string"


def base_figures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def prose(rng, n):
    common = ["the", "of", "and", "to", "in", "that", "is", "for"]
    made = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    return " ".join(rng.choice(common) if rng.random() < 0.35 else rng.choice(made) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    sound = [prose(rng, rng.randint(60, 300)) for _ in range(40)]
    odd = [
        None, "", " \t\n", "a", "x " * 7, "x " * 8, "x " * 9, "one\ntwo\none\n\none\n \n",
        "é漢\U0001F600 #*$%&|<> \x0b\x0c\r z\xa0y", prose(rng, 20) + "\n" + prose(rng, 30),
        sound[0] + " " + sound[0], sound[1][:200] + "\n" + sound[1], prose(rng, 5000),
        "word " * 6000, "y" * 100_000,
    ]
    junk = [prose(rng, 150).upper().replace(" ", "!! "), prose(rng, 150).replace(" ", "*** "),
            " | ".join(w for w in prose(rng, 600).split() if w not in quality.COMMON_WORDS["en"])]
    return sound, odd, junk


def test_base_figures_equal_brute_force(spark, texts):
    every = [t for part in texts for t in part]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(every)], SCHEMA)
    rows = {r.doc_id: r for r in quality.quality_report(docs).collect()}
    assert len(rows) == len(every)
    for i, t in enumerate(every):
        found = tuple(rows[i][c] for c in quality.BASE)
        assert found == base_figures(t), (t or "")[:60]
        assert rows[i].base_failed == (found[0] < 20 or 100 * found[4] > 30 * found[0])


def test_sound_texts_stay_and_junk_goes(spark, texts):
    sound, _, junk = texts
    rows = [(i, t, "en") for i, t in enumerate(sound)] + [(100 + i, t, "en") for i, t in enumerate(junk)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.doc_id for r in quality.quality_report(docs).filter("kept").collect()}
    assert kept == set(range(len(sound)))
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == kept


def test_distance_is_symmetric_and_bounded(spark):
    df = spark.createDataFrame([([1, 0], [0, 5]), ([1, 1], [3, 3]), ([2, 1], [1, 2]), ([0, 0], [1, 1])],
                               "p array<long>, q array<long>")
    rows = df.select(quality.js_distance(F.col("p"), F.col("q")).alias("a"),
                     quality.js_distance(F.col("q"), F.col("p")).alias("b")).collect()
    assert rows[0].a == pytest.approx(1) and rows[1].a == pytest.approx(0)
    assert 0 < rows[2].a < 1 and rows[2].a == pytest.approx(rows[2].b)
    assert rows[3].a is None


def test_undeclared_language_is_held_against_the_nearest(spark, texts):
    sound, _, junk = texts
    rows = [(i, t, "en") for i, t in enumerate(sound)]
    rows += [(200, sound[3], None), (201, sound[4], "xx"), (202, junk[0], None), (203, sound[5], "de")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.doc_id: r.kept for r in quality.quality_report(docs).collect()}
    assert kept[200] and kept[201] and not kept[202]


def test_repeated_rows_clashing_columns_and_no_rows(spark, texts):
    sound = texts[0]
    docs = spark.createDataFrame([(1, t, "en") for t in sound[:3] * 2], SCHEMA).withColumns(
        {"n_words": F.lit("mine"), "_text": F.lit("x"), "kept": F.lit(1), "_classes": F.lit(2)})
    assert quality.quality_report(docs).count() == 6
    good = quality.keep_good(docs)
    assert good.columns == docs.columns and good.count() == 6
    assert {r.n_words for r in good.collect()} == {"mine"}
    assert quality.quality_report(docs.limit(0)).count() == 0
    assert quality.keep_good(docs.limit(0)).count() == 0
