import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stormfare.llm import mixing, ngram, quality, secrets
from test_ngram import brute as groups_of
from test_quality_rules import prose

tiktoken = pytest.importorskip("tiktoken")
VOCABULARY = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(6)
    rows = []
    for i in range(160):
        text = prose(rng, rng.randint(50, 200))
        if i % 5 == 0:
            text += ' token = "1eb9c654e721b4f812088970e66a6345cee33dd6" end'
        if i % 11 == 0:
            text = text.upper().replace(" ", "!! ")
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    rows += [(200 + i, rows[1][1] + f" w{i}", "en", "s9", 0) for i in range(12)]
    rows += [(300, None, None, None, None), (301, "", "de", None, 0), (302, rows[2][1], "en", "s1", 1)]
    path = tmp_path_factory.mktemp("corpus")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near duplicates", "secret masking", "source mixing", "byte BPE"]


def test_run_equals_the_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    kept = {r.doc_id for r in quality.quality_report(docs).filter("kept").collect()}
    assert 0 < len(kept) < len(text)
    groups = groups_of([(i, text[i]) for i in kept])
    kept = {i for i in kept if groups[i][1] == i}
    clean = {i: secrets.redacted(text[i], secrets.find_secrets(text[i])[1]) for i in kept}
    assert any(secrets.MASK in t for t in clean.values())
    rest = spark.createDataFrame([(i, t, source[i]) for i, t in clean.items()], "doc_id long, text string, source string")
    copies = {r.doc_id: r.taken // r["size"] for r in mixing.mixing_report(rest).collect()}
    with open(VOCABULARY.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=VOCABULARY.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for i, n in copies.items():
        ids = np.array(library.encode_ordinary(clean[i]), "<u4").tobytes()
        expected += [(i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(clean[i].encode()).hexdigest())] * n
    rows = corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, rows)) == sorted(expected)


def test_all_but_the_last_return_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_text", F.lit("own"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_quality_filter_keeps_its_place(spark, folder, capsys):
    """Moved below the figures, the filter would compute each of them many times."""
    quality.keep_good(spark.read.parquet(f"{folder}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert plan.count("split(") <= 3 and plan.count("sort_array") <= 2
