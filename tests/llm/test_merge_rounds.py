import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stormfare.llm import merge_rounds
from stormfare.llm.merge_rounds import MergeRounds

tokenizers = pytest.importorskip("tokenizers")
VOCABULARY = pytest.importorskip("public_tokenizers")
FILE = VOCABULARY.path("byte_bpe_50k.json")


def random_texts(n, seed=11):
    rng = random.Random(seed)
    parts = list("abcde fg  \n\t\r\x1c\x1f\x85\xa0  ​'sld\xe9漢1\xb2٣.,!%\U0001F600́")
    parts += ["the", "ing", " ", " ", "<|endoftext|>", "<|end", "'re", "  "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


TEXTS = random_texts(4000) + [
    None, "", " ", "a" * 5000, " " * 3000, "ab" * 700 + " x", "=" * 600, "word " * 20_000, "<|endoftext|>",
    "x<|endoftext|>y <|endoftext|><|endoftext|> z", "x\n\n\n y  z ", "\n  \n", "aaa" * 333,
    "".join(random.Random(2).choice("etaoinshrdlu") for _ in range(30_000))]


@pytest.fixture(scope="module")
def library():
    found = tokenizers.Tokenizer.from_file(FILE)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def content():
    with open(FILE, "rb") as file:
        return file.read()


def test_equals_the_library_and_decodes(spark, library):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs = docs.withColumns({"ids": F.lit(1), "key": F.lit("x"), "n_tokens": F.lit(0)})
    rows = {r.doc_id: r for r in merge_rounds.round_trip(docs.repartition(3), FILE).collect()}
    plain = {r.doc_id: bytes(r.ids) for r in merge_rounds.encode_texts(docs, FILE).collect()}
    assert len(rows) == len(plain) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        own = library.encode(text or "", add_special_tokens=False).ids
        ids = np.array(own, "<u4").tobytes()
        assert plain[i] == ids, repr(text[:80])
        decoded = library.decode(own, skip_special_tokens=False)
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (
            len(own), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert merge_rounds.round_trip(docs.limit(0), FILE).count() == 0


def test_small_fronts_batches_and_memories_change_nothing(library, content, monkeypatch):
    for name, value in {"FRONT_ROWS": 5, "BYTES_PER_MERGE": 9, "KNOWN": 4}.items():
        monkeypatch.setattr(merge_rounds, name, value)
    machine = MergeRounds(content)
    for at in range(0, 300, 30):
        part = TEXTS[at:at + 30]
        found = machine.encode(pa.array(part, pa.string()))
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in part]


def plain_merge(machine, piece):
    """One pair at a time: the leftmost of the lowest rank."""
    ranks = dict(zip(machine.keys.tolist(), machine.ranks.tolist()))
    ids = machine.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    while True:
        pairs = [(ranks[k], i) for i in range(len(ids) - 1) if (k := ids[i] << 32 | ids[i + 1]) in ranks]
        if not pairs:
            return ids
        rank, i = min(pairs)
        ids[i:i + 2] = [int(machine.made[rank])]


@pytest.mark.parametrize("ordered", [True, False])
def test_rounds_equal_one_pair_at_a_time(content, ordered):
    machine = MergeRounds(content)
    assert machine.ordered
    machine.ordered = ordered
    rng = random.Random(5)
    pieces = ["".join(rng.choice("thinged ") for _ in range(rng.randint(1, 70))) for _ in range(300)]
    pieces += ["a" * n for n in range(1, 40)]
    assert [np.frombuffer(f, "<u4").tolist() for f in machine.pieces(pieces)] == [plain_merge(machine, p.encode()) for p in pieces]


def test_a_vocabulary_whose_merges_are_out_of_order(content):
    """(ab, c) ranks before (a, b): equal pairs may not go together."""
    given = json.loads(content)
    given["model"]["merges"] = [["ab", "c"], ["a", "b"], ["b", "c"]]
    given["model"]["vocab"] |= {"abc": 60_000}
    machine = MergeRounds(json.dumps(given).encode())
    assert not machine.ordered
    for piece in ("abcabc", "bcabab", "ababcbc"):
        assert np.frombuffer(machine.pieces([piece])[0], "<u4").tolist() == plain_merge(machine, piece.encode())


def test_ids_that_stand_for_nothing_and_other_vocabularies(spark, content):
    ids = np.array([64, 4_000_000, 50256, 200], "<u4").tobytes()
    rows = merge_rounds.decode_ids(spark.createDataFrame([(1, ids), (2, None)], "doc_id int, ids binary"), FILE).collect()
    assert rows[0].text.startswith("a<|endoftext|>") and rows[1].text == ""
    with pytest.raises(ValueError, match="plain"):
        MergeRounds(json.dumps(json.loads(content) | {"normalizer": {"type": "Lowercase"}}).encode())
