import base64
import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormfare.llm import bpe, token_files

tiktoken = pytest.importorskip("tiktoken")
VOCABULARY = pytest.importorskip("public_tokenizers")
RANKS, WORDS = VOCABULARY.path("byte_bpe_50k.tiktoken"), VOCABULARY.path("word_bpe_49k.json")


def random_texts(n, seed=3):
    rng = random.Random(seed)
    parts = list("abcde fg  \n\t\r\x1c\x85\xa0 ​'sldé漢1²٣.,!%\U0001F600́") + ["the", "ing", " ", " "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


TEXTS = random_texts(3000) + [None, "", "a" * 5000, " " * 3000, "ab" * 700 + " x", "=" * 600, "word " * 20_000,
                              "<|endoftext|> plain", "x\n\n\n y  z ", "\n  \n"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=VOCABULARY.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_that_of_the_vocabulary():
    assert bpe.PATTERN == VOCABULARY.PATTERN


def test_byte_bpe_equals_the_library(spark, library):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").withColumn("ids", F.lit(1))
    rows = bpe.encode_texts(docs.repartition(3), RANKS, keep_ids=True).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r.doc_id] or ""
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        assert bytes(r.ids) == ids, text[:50]
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_texts(docs.limit(0), RANKS).count() == 0


def test_workers_hold_the_vocabulary_alone_between_tasks(spark, library):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(8)

    def held(batches):
        import pyarrow as pa

        from stormfare.llm import vocabulary

        list(batches)
        machines = [m for m in vocabulary._built.values() if isinstance(m, bpe.ByteBpe)]
        known = sum(len(m.pieces) + len(m.first) + len(m.later) for m in machines)
        opened = sum(vars(m).get("_db", vars(m).get("db")) is not None for m in machines)
        yield pa.RecordBatch.from_pydict({"machines": [len(machines)], "known": [known], "opened": [opened]})

    for _ in range(2):  # a worker that has rested goes on
        rows = bpe.encode_texts(docs, RANKS).collect()
        assert {r.doc_id: r.n_tokens for r in rows} == {
            i: len(library.encode_ordinary(t or "")) for i, t in enumerate(TEXTS)}
        state = spark.range(0, 64, 1, 64).mapInArrow(held, "machines long, known long, opened long").collect()
        assert any(r.machines for r in state)
        assert all((r.known, r.opened) == (0, 0) for r in state)


def test_forgetting_what_is_known_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 5)
    monkeypatch.setattr(bpe, "KNOWN_CHUNKS", 5)
    monkeypatch.setattr(bpe, "PIECES_PER_QUERY", 7)
    monkeypatch.setattr(bpe, "TOKENS_PER_QUERY", 11)
    with open(RANKS, "rb") as file:
        machine = bpe.ByteBpe(file.read())
    for at in range(0, 300, 30):
        part = TEXTS[at:at + 30]
        encoded = machine.encode(part)
        assert [np.frombuffer(e, "<u4").tolist() for e in encoded] == [library.encode_ordinary(t) for t in part]
        assert machine.decode(encoded) == [t.encode() for t in part]


def test_words_are_not_cut_and_pieces_of_present_texts_stay_known(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 5)
    monkeypatch.setattr(bpe, "KNOWN_CHUNKS", 5)
    with open(RANKS, "rb") as file:
        machine = bpe.ByteBpe(file.read())
    text = "Thstinnt ndhalyti élleçque 漢字字漢 hawhthnd. x11y22 =!=!= oneation-ther\nerthed\n lyo'lll \x1cqq eroring"
    pattern, merge, cut, merged = machine.pattern, machine._merge, [], []

    class Counting:
        def findall(self, given):
            cut.extend(given.split(" "))
            return pattern.findall(given)

    machine.pattern = Counting()
    monkeypatch.setattr(machine, "_merge", lambda pieces: (merged.extend(pieces), merge(pieces)))
    for n in range(2):
        assert np.frombuffer(machine.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)
        assert (n == 0) == any(cut) == any(merged)
        assert not {"ndhalyti", "élleçque", "漢字字漢", "eroring"} & set(cut)
        cut.clear()
        merged.clear()


def test_chunks_beside_white_space_are_cut_as_in_the_text(library):
    white = [c for c in map(chr, range(0x110000)) if c.isspace()]
    odd = ["é", "1", "'s", "'", "x'll,", "ª²", "\u0301", "\u200b", "\U0001F600", "\U00020000", "\U0001E900"]
    texts = [a + w + b for w in white for a in odd for b in odd]
    texts += [f"{w}{a} {a}{w} {w}{w}{a} {a}" for w in white for a in odd]
    with open(RANKS, "rb") as file:
        machine = bpe.ByteBpe(file.read())
    for given in (texts, [" ".join(texts[i::7]) for i in range(7)], texts[:50]):
        encoded = machine.encode(given)
        assert [np.frombuffer(e, "<u4").tolist() for e in encoded] == [library.encode_ordinary(t) for t in given]
        assert machine.decode(encoded) == [t.encode() for t in given]


def test_letters_throughout_are_one_piece(library):
    import pyarrow as pa
    import pyarrow.compute as pc
    import regex

    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    letters = [c for c, is_letter in zip(every, pc.utf8_is_alpha(pa.array(every)).to_pylist()) if is_letter]
    assert all(map(regex.compile(r"\p{L}").match, letters)) and len(letters) > 100_000


def test_long_pieces_agree_with_the_query(monkeypatch):
    with open(RANKS, "rb") as file:
        machine = bpe.ByteBpe(file.read())
    rng = random.Random(1)
    for _ in range(200):
        piece = "".join(rng.choice("thinged") for _ in range(rng.randint(1, 60)))
        machine._merge([piece])
        assert machine._merge_long(piece) == machine.pieces[piece]


def test_token_files_equal_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    rows = [(3 * i - 100, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([*rows, (None, "lost")], "doc_id long, text string").withColumn("start", F.lit("mine"))
    folder = str(tmp_path / "files")
    for _ in range(2):  # writing again replaces the files
        parts = token_files.write_token_files(docs.repartition(4), folder, WORDS)
    assert sum(p["docs"] for p in parts) == len(rows)
    assert not [f for f in os.listdir(folder) if f.startswith(".")]
    found = {r.key: r for r in token_files.read_token_files(spark, folder).collect()}
    start = 0
    for (key, text), own in zip(rows, tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array(own.ids + [2], "<u4")
        assert (found[key].start, found[key].n_tokens, found[key].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    offsets = np.memmap(os.path.join(folder, f"offsets-{parts[0]['part']:05d}.bin"), "<u8", "r")
    assert offsets.dtype == np.uint64 and offsets[0] == 0 and offsets[-1] == parts[0]["tokens"]


def test_no_documents_repeated_ones_and_remote_folders(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, None)], "doc_id long, text string")
    rows = token_files.token_file_report(docs, WORDS).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(1, 0, 1), (1, 1, 3), (1, 4, 3)]
    assert token_files.token_file_report(docs.limit(0), WORDS).count() == 0
    with pytest.raises(ValueError, match="mounted"):
        token_files.local_folder("s3://bucket/x")


def test_documents_without_a_key_come_last(spark, tmp_path):
    rows = [(None, f"lost {i % 7}") for i in range(60)] + [(i // 2, f"word {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit("mine"), "part": F.lit(1)})
    folder = str(tmp_path / "files")
    parts = token_files.write_token_files(docs.repartition(4), folder, WORDS)
    assert (sum(p["docs"] for p in parts), sum(p["unkeyed"] for p in parts)) == (40, 60)
    found = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.key for r in found] == [i // 2 for i in range(40)] + [None] * 60
    ends = np.cumsum([r.n_tokens for r in found])
    assert [r.start for r in found] == [0, *ends[:-1]]
    token_files.write_token_files(docs.filter("doc_id IS NULL"), folder, WORDS)
    assert [r.key for r in token_files.read_token_files(spark, folder).collect()] == [None] * 60
