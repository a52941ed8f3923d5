"""Byte-level BPE by batched numpy merge rounds.

The bytes of many distinct pieces lie in one flat array of symbols, linked to
their neighbours. A round looks up neighbouring pairs by binary search over the
sorted pair keys of the merge table, takes every piece's lowest rank, and
contracts all its places at once, from the left where they overlap; only pairs
next to a contraction are looked up again. Of long pieces the lowest
``FRONT_ROWS`` pairs are on the table at a time, so a round does not cost a pass
over the piece. Decoding gathers the bytes of all ids by their offsets.

The vocabulary is a file of the tokenizers library: byte-level pre-tokenization
by its fixed pattern, special tokens taken from the text where they occur. Texts
are first cut at spaces and equal chunks are cut by the pattern once; that gives
the same pieces unless white space comes in runs of three, or of two at the end,
or a special token occurs; such texts are cut whole.

Defined results: null text counts as empty and has no ids; equal rows give equal
results; other columns are ignored; ids that are null or not in the vocabulary
are left out when decoding, and bytes that are not UTF-8 become U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from stormfare.llm.vocabulary import built, sent

#: The byte-level pre-tokenizer's pattern; fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts that are not cut at spaces: white space in runs of three or two at the end, or beyond the usual characters.
UNSAFE = r"[\t\n\f\r ][\t\n\f\r ](?:[\t\n\f\r ]|\z)|[\x0B\x1C-\x1F\x85]|[^\P{Z} ]"
NONE = np.int64(1) << np.int64(62)  # the rank of a pair that does not merge
FRONT_ROWS = 16_384
CHARS_PER_ROUND = 1_000_000
BYTES_PER_MERGE = 1_000_000
#: Chunks of a worker's generation; the one before is kept too, so frequent chunks are never forgotten.
KNOWN = 200_000


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class TokenBytes:
    """Decoder of one vocabulary file: the bytes of all tokens, one behind the other."""

    def __init__(self, content: bytes):
        self._take(json.loads(content))

    def _take(self, given: dict) -> None:
        letters, ids = byte_letters(), given["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in given.get("added_tokens") or []}
        spelled = {i: bytes(letters[c] for c in token) for token, i in ids.items() if token not in self.special}
        spelled.update((i, token.encode()) for token, i in self.special.items())
        self.size = max(spelled) + 1
        self.lengths = np.array([len(spelled.get(i, b"")) for i in range(self.size)], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.bytes = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(self.size)), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        ids = ids.astype(np.int64)
        ids = ids[(ids >= 0) & (ids < self.size)]
        lengths = self.lengths[ids]
        return self.bytes[_spans(self.ends[ids] - lengths, lengths)].tobytes()


class MergeRounds(TokenBytes):
    """Encoder of one vocabulary file."""

    def _take(self, given: dict) -> None:
        super()._take(given)
        model, before = given["model"], given["pre_tokenizer"] or {}
        added = given.get("added_tokens") or []
        plain = (
            model["type"] == "BPE" and not given["normalizer"] and before.get("type") == "ByteLevel"
            and not before["add_prefix_space"] and before.get("use_regex", True)
            and not any(model.get(k) for k in (
                "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip"))
        )
        if not plain:
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters, ids = byte_letters(), model["vocab"]
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64).reshape(-1)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int64).reshape(-1)
        first = {}
        for rank, new in enumerate(self.made.tolist()):
            first.setdefault(new, rank)
        # Where no merge uses a token that only a later merge makes, equal pairs can go in one round.
        self.ordered = len(first) == len(merges) and all(
            first.get(ids[part], -1) < rank for rank, m in enumerate(merges) for part in m)

        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut_special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, bytes] = {}  # ids as little-endian unsigned 32-bit integers
        self.older: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of symbols; a symbol of -1 has none."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (right >= 0), self.ranks[at], NONE)

    def merged(self, symbols: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is left of the symbols when no pair merges, and the piece of each; ``piece`` ascends."""
        n = len(symbols)
        symbols = np.append(symbols, -1)  # behind the last one
        after = np.where(np.append(piece[1:], -1) == piece, np.arange(1, n + 1), n)
        after = np.append(after, n)
        before = np.full(n + 1, n)
        before[after[:n]] = np.arange(n)
        rank = np.append(self._ranks(symbols[:n], symbols[after[:n]]), NONE)
        alive = np.ones(n, bool)
        lowest = np.full(int(piece[-1]) + 1 if n else 0, NONE)
        while True:
            front = np.flatnonzero(rank < NONE)
            if not len(front):
                return symbols[:n][alive], piece[alive]
            limit = NONE - 1
            if self.ordered and len(front) > FRONT_ROWS:
                limit = np.partition(rank[front], FRONT_ROWS)[FRONT_ROWS]
                front = front[rank[front] <= limit]
            while len(front):
                own = piece[front]
                np.minimum.at(lowest, own, rank[front])
                chosen = front[rank[front] == lowest[own]]
                lowest[own] = NONE
                if self.ordered:
                    # Of places that overlap, the first, third and so on of a run.
                    runs = np.ones(len(chosen), bool)
                    runs[1:] = after[chosen[:-1]] != chosen[1:]
                    place = np.arange(len(chosen))
                    chosen = chosen[(place - np.maximum.accumulate(np.where(runs, place, 0))) % 2 == 0]
                else:
                    chosen = chosen[np.unique(piece[chosen], return_index=True)[1]]
                gone = after[chosen]
                symbols[chosen] = self.made[rank[chosen]]
                after[chosen] = after[gone]
                before[after[chosen]] = chosen
                alive[gone] = False
                rank[gone] = NONE
                touched = _merged_places(chosen, before[chosen])
                touched = touched[touched < n]
                touched = touched[(after[touched] < n) | (rank[touched] < NONE)]
                rank[touched] = self._ranks(symbols[touched], symbols[after[touched]])
                front = _merged_places(front, touched)
                front = front[rank[front] <= limit]

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece."""
        found: list[bytes] = []
        for part in _by_size([p.encode() for p in pieces], BYTES_PER_MERGE):
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            symbols = self.byte_ids[np.frombuffer(b"".join(part), np.uint8)]
            ids, piece = self.merged(symbols, np.repeat(np.arange(len(part)), lengths))
            flat, begin = ids.astype("<u4").tobytes(), 0
            for end in (4 * np.cumsum(np.bincount(piece, minlength=len(part)))).tolist():
                found.append(flat[begin:end])
                begin = end
        return found

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, which the pattern cuts by itself."""
        if len(self.known) > KNOWN:
            self.known, self.older = {}, self.known
        known = self.known
        new = []
        for c in chunks:
            if c not in known:
                old = self.older.get(c)
                if old is None:
                    new.append(c)
                else:
                    known[c] = old
        cut = [self.pattern.findall(c) for c in new]
        distinct = list(dict.fromkeys(p for c in cut for p in c))
        ids = dict(zip(distinct, self.pieces(distinct)))
        for c, parts in zip(new, cut):
            known[c] = b"".join(map(ids.__getitem__, parts))
        return [known[c] for c in chunks]

    def _whole(self, text: str) -> bytes:
        """Ids of a text with special tokens or long white space."""
        found, at = [], 0
        places = self.cut_special.finditer(text) if self.cut_special else ()
        for match in [*places, None]:
            cut = self.pattern.findall(text[at:match.start() if match else len(text)])
            distinct = list(dict.fromkeys(cut))
            ids = dict(zip(distinct, self._chunks(distinct)))
            found += map(ids.__getitem__, cut)
            if match:
                found.append(self.special[match.group()].to_bytes(4, "little"))
                at = match.end()
        return b"".join(found)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, nulls as empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = pc.match_substring_regex(texts, UNSAFE)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        found = [b""] * len(texts)
        for i in np.flatnonzero(odd).tolist():
            found[i] = self._whole(texts[i].as_py())
        usual = np.flatnonzero(~odd)
        if len(usual):
            split = pc.split_pattern(texts.take(pa.array(usual)), " ")
            ends = split.offsets.to_numpy()
            coded = split.flatten().dictionary_encode()
            codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
            # Chunks behind a space keep it; the first of a text has none.
            first = np.zeros(len(codes), bool)
            first[ends[:-1] - ends[0]] = True
            later_codes, first_codes = np.unique(codes[~first]), np.unique(codes[first])
            chunks = [" " + words[c] for c in later_codes] + [words[c] for c in first_codes]
            ids = self._chunks(chunks)
            place = np.zeros(2 * len(words), np.int64)
            place[later_codes] = np.arange(len(later_codes))
            place[len(words) + first_codes] = len(later_codes) + np.arange(len(first_codes))
            taken = place[codes + np.where(first, len(words), 0)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            starts = np.cumsum(lengths) - lengths
            flat = np.frombuffer(b"".join(ids), "<u4")[_spans(starts[taken], lengths[taken])].tobytes()
            sizes = 4 * np.concatenate([[0], np.cumsum(lengths[taken])])[ends - ends[0]]
            for i, begin, end in zip(usual.tolist(), sizes[:-1].tolist(), sizes[1:].tolist()):
                found[i] = flat[begin:end]
        return found


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places from each start on, one span after the other."""
    total = np.cumsum(lengths)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)


def _merged_places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The places of two ascending lists, ascending, once each."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return both[np.append(True, both[1:] != both[:-1])] if len(both) else both


def _by_size(values: list[bytes], most: int) -> Iterator[list[bytes]]:
    part, size = [], 0
    for value in values:
        if part and size + len(value) > most:
            yield part
            part, size = [], 0
        part.append(value)
        size += len(value)
    if part:
        yield part


def _rounds(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive texts of together about so many characters, one at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < len(texts):
        reach = np.cumsum(sizes[at:])
        n = max(1, int(np.searchsorted(reach, CHARS_PER_ROUND, side="right")))
        yield texts.slice(at, n)
        at += n


def encode_texts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ids (little-endian unsigned 32-bit integers) of every text."""
    taken = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    content = sent(docs.sparkSession, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = built(MergeRounds, content.value)
        for batch in batches:
            at = 0
            for texts in _rounds(batch.column(1)):
                ids = pa.array(machine.encode(texts), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], names=["key", "ids"])
                at += len(texts)

    kind = taken.schema["key"].dataType.simpleString()
    return taken.mapInArrow(encode, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode_ids(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Key, ids and the text that the ids stand for."""
    taken = encoded.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").alias("ids"))
    content = sent(encoded.sparkSession, vocabulary)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = built(TokenBytes, content.value)
        for batch in batches:
            texts = (machine.decode(np.frombuffer(v.as_py() or b"", "<u4")) for v in batch.column(1))
            out = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), out], names=["key", "ids", "text"])

    kind = taken.schema["key"].dataType.simpleString()
    decoded = taken.mapInArrow(decode, f"key {kind}, ids binary, text string")
    return decoded.withColumnsRenamed({"key": key, "ids": ids})


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, number of ids, digests of the ids and of the decoded text."""
    decoded = decode_ids(encode_texts(docs, vocabulary, key, text), vocabulary, key)
    return decoded.select(
        F.col(f"`{key}`"), F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
