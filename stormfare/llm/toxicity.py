"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon and of its stems, how often lexicon
words stand near the second person, shares of capitals, of punctuation and of
words that look obfuscated. The lexicon is learned from the labelled training
documents: words and word beginnings of ``STEM`` letters that occur in many
toxic and hardly any other documents. It has at most ``LEXICON`` entries, so it
is part of the plan, as are the trees.

Training features come from cross-fitted lexicons, each half's from the other half, so the trees learn how
far the lexicon can be trusted on new documents.

Trees and calibration are fitted on at most about ``TRAIN_ROWS`` labelled
documents, chosen by a hash. Of these, one quarter calibrates: isotonic
regression maps the trees' probability to the share of toxic documents. Labels
are read for training rows only, those whose ``crc32(key) % 4`` is not 2.

Defined results: null text counts as empty and is scored as such; without
training rows of both labels every score is 0; labels that are null are not
used; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from stormfare.llm.text import whole_text
from stormfare.session import written

TRAIN_ROWS = 30_000
LEXICON = 300
STEM = 4
#: An entry stands in so many toxic training documents, and in such a share of them, at least.
MIN_TOXIC_DOCS, MIN_TOXIC_SHARE = 4, 0.005
#: A lexicon entry's share of toxic documents is so many times that of others, at least.
MIN_LIFT = 8.0
TREES, DEPTH = 20, 4
PREDICT_AT = 0.3
SEED = 11

SECOND_PERSON = (
    "you", "your", "yours", "du", "dich", "dir", "dein", "ihr", "euch",
    "tu", "toi", "ton", "ta", "vous", "votre", "usted", "ustedes", "te", "tus",
)
FEATURES = (
    "words_log", "lexicon_words", "lexicon_any", "stem_words", "stem_any", "near_you",
    "second_person", "capitals", "punctuation", "exclamation", "obfuscated", "repeated",
)


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def _tokens(text: Column) -> Column:
    """Runs of letters, lower-cased."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def learned_lexicon(train: DataFrame) -> tuple[list[str], list[str]]:
    """Words, and beginnings of words, that tell toxic documents (text, toxic) apart."""
    tokens = train.select("toxic", F.array_distinct(_tokens(F.col("text"))).alias("tokens"))
    stems = F.array_distinct(F.transform(
        F.filter("tokens", lambda w: F.length(w) >= STEM), lambda w: F.concat(F.lit("^"), F.substring(w, 1, STEM))))
    each = tokens.select("toxic", F.explode(F.concat("tokens", stems)).alias("entry"))
    totals = train.agg(
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"),
        F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0)).alias("c")).first()
    counted = each.groupBy("entry").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).filter(
            F.col("t") >= max(MIN_TOXIC_DOCS, MIN_TOXIC_SHARE * totals["t"]))
    lift = ((F.col("t") + 0.5) / (totals["t"] + 1)) / ((F.col("c") + 0.5) / (totals["c"] + 1))
    ranked = counted.withColumn("lift", lift).filter(F.col("lift") >= MIN_LIFT)
    best = ranked.orderBy(F.desc(F.col("t") * F.log("lift")), "entry").limit(LEXICON).collect()
    found = [r["entry"] for r in best]
    return sorted(w for w in found if w[0] != "^"), sorted(w[1:] for w in found if w[0] == "^")


def with_features(docs: DataFrame, words: list[str], stems: list[str]) -> DataFrame:
    """Adds the features of column ``text``. Word lists are looked up, not searched one by one."""
    df = docs.withColumns({"_t": F.col("text"), "_w": _tokens(F.col("text"))})
    df = df.withColumns({
        "_n": F.greatest(F.size("_w"), F.lit(1)).cast("double"),
        "_chars": F.greatest(F.length("_t"), F.lit(1)).cast("double"),
        "_lexicon": F.filter("_w", lambda w: w.isin(words) if words else F.lit(False)),
        "_stems": F.filter("_w", lambda w: F.substring(w, 1, STEM).isin(stems) if stems else F.lit(False)),
    })

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace("_t", pattern, "")) / F.col("_chars")

    you = "|".join(SECOND_PERSON)
    listed = "|".join(map(re.escape, words)) or "(?!)"
    between = r"(?:[^\p{L}]+\p{L}+){0,3}[^\p{L}]+"
    near = (rf"(?iu)(?<!\p{{L}})(?:(?:{you}){between}(?:{listed})|(?:{listed}){between}(?:{you}))(?!\p{{L}})")
    has_lexicon = F.size("_lexicon") > 0
    return df.withColumns({
        "words_log": F.log1p("_n"),
        "lexicon_words": F.size("_lexicon") / F.col("_n"),
        "lexicon_any": F.least(F.size("_lexicon"), F.lit(10)).cast("double"),
        "stem_words": F.size("_stems") / F.col("_n"),
        "stem_any": F.least(F.size("_stems"), F.lit(10)).cast("double"),
        # Only texts with a lexicon word are searched for its neighbours.
        "near_you": F.when(has_lexicon, F.regexp_count("_t", F.lit(near)) / F.col("_n")).otherwise(0.0),
        "second_person": F.size(F.filter("_w", lambda w: w.isin(*SECOND_PERSON))) / F.col("_n"),
        "capitals": share(r"[^\p{Lu}]+"),
        "punctuation": share(r"[\p{L}\p{N}\s]+"),
        "exclamation": share(r"[^!?]+"),
        # Letters with digits or symbols between them.
        "obfuscated": F.regexp_count("_t", F.lit(r"\p{L}[0-9@$*#]+\p{L}")) / F.col("_n"),
        "repeated": 1 - F.size(F.array_distinct("_w")) / F.col("_n"),
    }).drop("_t", "_w", "_n", "_chars", "_lexicon", "_stems")


class Model:
    """A fitted lexicon, trees and calibration."""

    def __init__(self, words, stems, trees, calibration):
        self.words, self.stems, self.trees, self.calibration = words, stems, trees, calibration


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(df)


def _probability(trees, df: DataFrame) -> DataFrame:
    scored = trees.transform(_assembled(df))
    return scored.withColumn("raw_score", vector_to_array("probability")[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic") -> Model | None:
    """The model of the training rows, or None where one of the labels is missing."""
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("toxic"))
    known = known.filter("key IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("key"))).distinct()
    rows = known.count()
    share = min(1.0, TRAIN_ROWS / max(rows, 1))
    part = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 20))
    chosen = known.filter(part < int(share * (1 << 20)) + 1)
    given = docs.select(F.col(f"`{key}`").alias("key"), whole_text(text).alias("text"))
    # At most about TRAIN_ROWS keys: the texts stay where they are.
    train = written(given.join(F.broadcast(chosen), "key"), "toxic-train")
    labels_seen = {r["toxic"] for r in train.select("toxic").distinct().collect()}
    if not {0, 1} <= labels_seen:
        return None
    # Each half gets its features by the other half's lexicon: a document's own words must not vouch for it.
    half = F.pmod(F.xxhash64("key", F.lit(SEED + 2)), F.lit(2))
    halves = [train.filter(half == i) for i in (0, 1)]
    parts = [with_features(halves[1 - i], *learned_lexicon(halves[i])).drop("text") for i in (0, 1)]
    features = written(parts[0].unionByName(parts[1]).withColumn(
        "calibrates", F.pmod(F.xxhash64("key", F.lit(SEED + 1)), F.lit(4)) == 0), "toxic-features")
    words, stems = learned_lexicon(train)
    ready = _assembled(features).withColumn("label", F.col("toxic").cast("double"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(ready.filter(~F.col("calibrates")))
    raw = _probability(trees, features.filter("calibrates")).select("raw_score", "toxic")
    if raw.isEmpty():
        raw = _probability(trees, features).select("raw_score", "toxic")
    calibration = IsotonicRegression(
        featuresCol="raw_score", labelCol="toxic", predictionCol="calibrated").fit(raw)
    return Model(words, stems, trees, calibration)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Held-out flag, score and prediction of every document."""
    given = docs.select(F.col(f"`{key}`").alias("key"), whole_text(text).alias("text"))
    if model is None:
        scored = given.withColumn("score", F.lit(0.0))
    else:
        raw = _probability(model.trees, with_features(given, model.words, model.stems).drop("text"))
        # Calibration is constant on stretches; a thousandth of the trees' score orders within them.
        mixed = 0.999 * F.col("calibrated") + 0.001 * F.col("raw_score")
        scored = model.calibration.transform(raw).withColumn(
            "score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), mixed)))
    return scored.select(
        F.col("key").alias(key), F.coalesce(held_out(F.col("key")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
