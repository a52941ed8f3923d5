"""Byte-level BPE in DuckDB, partition by partition.

A text is cut into the pieces of the vocabulary's pattern. Distinct pieces not
yet known to the worker become rows (piece, position, token with its successor),
first one token per byte. A recursive query joins these pairs with the merge
table and contracts every piece's leftmost pair of minimum rank, until no piece
has a pair left. A row holds its whole pair: contracting one changes the two
rows beside it and drops its own, so no step has to look for neighbours. Decoding
joins the ids of a batch with the vocabulary and concatenates their bytes in order.

Cutting whole texts by the pattern costs more than merging, so texts are first
split at spaces; only distinct chunks are cut, and the pattern runs on those that
are not letters throughout, which are one piece each. That gives the same
pieces unless white space comes in runs of three, or of two at the end; such
texts are cut whole. Chunks, pieces and ids stay in flat arrays.

A recursive step costs at least one pass over the piece, so a piece of n bytes
takes up to n passes. Pieces of more than ``LONG_PIECE`` bytes, which prose does
not have, are merged with a heap instead; the result is the same.

Between tasks a worker keeps the vocabulary alone, not the pieces it has seen nor
the database: idle workers share an executor's memory with the stages that follow.

Defined results: null text counts as empty and has no ids; equal rows give equal
results; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from stormfare.llm.vocabulary import built, sent

#: The pattern that goes with the vocabulary; fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A run of white space that splitting at spaces would cut otherwise, for Arrow's expressions.
UNSAFE = r"[\t-\r\x1c-\x1f\x{85}\pZ]{2}(?:[\t-\r\x1c-\x1f\x{85}\pZ]|\z)"
#: White space at an end, or nothing at all.
ENDS = r"\A(?:\z|[\t-\r\x1c-\x1f\x{85}\pZ])|[\t-\r\x1c-\x1f\x{85}\pZ]\z"
LONG_PIECE = 512
PIECES_PER_QUERY = 15_000
TOKENS_PER_QUERY = 500_000
CHARS_PER_ROUND = 2_000_000
#: Known pieces, and known chunks; a worker that has more forgets those not in its present texts and goes on.
KNOWN_PIECES, KNOWN_CHUNKS = 250_000, 100_000

_BITS = 20  # of a row key, for the position within a piece
_MASK = (1 << _BITS) - 1
_END = 0xFFFFFFFF  # in place of the successor of a piece's last token; no merge has it

# A pair is token << 32 | successor. Rows of pieces that have no merge left come out once more, as done.
ENCODE = f"""
WITH RECURSIVE step(w, place, pair, done) AS (
  SELECT w, place, pair, FALSE FROM start
  UNION ALL
  (WITH best AS (
     SELECT w, min((id << {_BITS}) | place) AS b FROM step JOIN merges USING (pair) WHERE NOT done GROUP BY w
   ), found AS (
     SELECT w, b >> {_BITS} AS id, (b & {_MASK})::INT AS spot FROM best
   )
   SELECT s.w, CASE WHEN place > spot THEN place - 1 ELSE place END,
          CASE place - spot WHEN 1 THEN (id << 32) | (pair & {_END})
                            WHEN -1 THEN ((pair >> 32) << 32) | id ELSE pair END,
          spot IS NULL
   FROM step s LEFT JOIN found ON found.w = s.w
   WHERE NOT done AND place IS DISTINCT FROM spot)
)
SELECT w, pair >> 32 AS t FROM step WHERE done ORDER BY w, place
"""

# The rows reach the aggregate in the order of ``place``: the connection has one thread.
DECODE = """
SELECT doc, string_agg(bytes, '') AS text
FROM (SELECT doc, place, bytes FROM tokens JOIN vocabulary USING (id) ORDER BY place) GROUP BY doc
"""


class Known:
    """Strings with their ids in flat arrays, looked up many at a time."""

    def __init__(self, keys: pa.Array | None = None, sizes: np.ndarray | None = None, ids: np.ndarray | None = None):
        self.keys = pa.array([], pa.large_string()) if keys is None else keys
        self.sizes = np.empty(0, np.int64) if sizes is None else sizes
        self.ids = np.empty(0, "<u4") if ids is None else ids

    def __len__(self) -> int:
        return len(self.keys)

    def __getitem__(self, key: str) -> bytes:
        place = self.places(pa.array([key], pa.large_string()))
        if place[0] < 0:
            raise KeyError(key)
        return _taken(self.sizes, self.ids, place)[1].tobytes()

    def places(self, keys: pa.Array) -> np.ndarray:
        """Where each key stands, -1 for those that are not known."""
        return pc.fill_null(pc.index_in(keys, value_set=self.keys), -1).to_numpy().astype(np.int64)

    def add(self, keys: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.keys = pa.concat_arrays([self.keys, keys])
        self.sizes, self.ids = np.append(self.sizes, sizes), np.append(self.ids, ids)

    def only(self, keys: pa.Array) -> Known:
        """What is known of these keys."""
        places = self.places(keys)
        places = np.unique(places[places >= 0])
        return Known(self.keys.take(pa.array(places)), *_taken(self.sizes, self.ids, places))


class ByteBpe:
    """Encoder and decoder of one vocabulary: lines of base64 token and rank."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.pattern = regex.compile(PATTERN)
        pairs, ids = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32) | right)
                    ids.append(rank)
        given = pa.table({"pair": pa.array(pairs, pa.int64()), "id": pa.array(ids, pa.int64())})
        words = pa.table({"id": pa.array(self.ranks.values(), pa.int64()),
                          "bytes": [t.decode("latin-1") for t in self.ranks]})
        self.tables = {"merges": given, "vocabulary": words}
        self._db: duckdb.DuckDBPyConnection | None = None
        by_text = {t.decode(): rank for t, rank in self.ranks.items() if _is_text(t)}
        self.tokens = Known(pa.array(by_text, pa.large_string()), np.ones(len(by_text), np.int64),
                            np.array(list(by_text.values()), "<u4"))
        self._know_nothing()

    def _know_nothing(self) -> None:
        self.pieces = Known()
        self.first = Known()  # chunks at the start of a text
        self.later = Known()  # chunks after a space, without it, that are not letters throughout

    @property
    def db(self) -> duckdb.DuckDBPyConnection:
        """The connection with both tables, opened when it is first needed."""
        if self._db is None:
            self._db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
            for name, table in self.tables.items():
                self._db.register("given", table)
                self._db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
                self._db.unregister("given")
        return self._db

    def rest(self) -> None:
        """Gives back what a task has learned and opened; the next one starts anew.

        A worker stays after its task, and all that it holds then lacks the stages that follow.
        """
        self._know_nothing()
        if self._db is not None:
            self._db.close()
            self._db = None
        pa.default_memory_pool().release_unused()

    def _merge(self, pieces: list[str] | pa.Array) -> None:
        """Ids of pieces, by the recursive query."""
        pieces = pa.array(pieces, pa.large_string())
        lengths = pc.binary_length(pieces).to_numpy()
        which = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        ends = np.cumsum(lengths)
        place = np.arange(len(which)) - np.repeat(ends - lengths, lengths)
        tokens = self.byte_ids[_bytes_of(pieces)]
        after = np.append(tokens[1:], _END)
        after[ends - 1] = _END
        start = pa.table({"w": which, "place": place.astype(np.int32), "pair": (tokens << 32) | after})
        self.db.register("start", start)
        found = self.db.sql(ENCODE).to_arrow_table()
        self.db.unregister("start")
        sizes = np.bincount(found["w"].to_numpy(), minlength=len(pieces))
        self.pieces.add(pieces, sizes, found["t"].to_numpy().astype("<u4"))

    def _merge_long(self, piece: str) -> bytes:
        """The same for one long piece: a heap of (rank, position) over linked tokens."""
        data = piece.encode()
        token = [data[i:i + 1] for i in range(len(data))]
        after, before = list(range(1, len(data) + 1)), list(range(-1, len(data) - 1))

        def pair(i: int) -> tuple | None:
            j = after[i]
            rank = self.ranks.get(token[i] + token[j]) if j < len(data) else None
            return None if rank is None else (rank, i, token[i], token[j])

        heap = [p for p in map(pair, range(len(data) - 1)) if p]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if token[i] != left or j >= len(data) or token[j] != right:
                continue
            token[i], token[j], after[i] = left + right, b"", after[j]
            if after[j] < len(data):
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (p := pair(k)):
                    heapq.heappush(heap, p)
        return np.array([self.ranks[t] for t in token if t], "<u4").tobytes()

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """Makes distinct pieces known, and tells where they stand."""
        if len(self.pieces) > KNOWN_PIECES:
            self.pieces = self.pieces.only(pieces)
        places = self.pieces.places(pieces)
        missing = np.flatnonzero(places < 0)
        new = pieces.take(pa.array(missing))
        token, lengths = self.tokens.places(new), pc.binary_length(new).to_numpy()
        whole = np.flatnonzero(token >= 0)  # a piece that is a token stands for itself
        short = np.flatnonzero((token < 0) & (lengths <= LONG_PIECE))
        long = np.flatnonzero((token < 0) & (lengths > LONG_PIECE))
        places[missing[np.concatenate([whole, short, long])]] = len(self.pieces) + np.arange(len(missing))
        self.pieces.add(new.take(pa.array(whole)), *_taken(self.tokens.sizes, self.tokens.ids, token[whole]))
        for i in range(0, len(short), PIECES_PER_QUERY):
            self._merge(new.take(pa.array(short[i:i + PIECES_PER_QUERY])))
        merged = [self._merge_long(new[i].as_py()) for i in long.tolist()]
        self.pieces.add(new.take(pa.array(long)), np.array([len(m) // 4 for m in merged], np.int64),
                        np.frombuffer(b"".join(merged), "<u4"))
        return places

    def _cut(self, chunks: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The number of pieces of each chunk, a space before it, and all pieces in order.

        At a space between two other characters a piece begins, and none goes on behind it. So chunks that have no
        white space at either end are cut in one string.
        """
        alone = pc.match_substring_regex(chunks, ENDS).to_numpy(zero_copy_only=False)
        cut = self.pattern.findall("".join(f" {c}" for c in chunks.filter(pa.array(~alone)).to_pylist()))
        joint = pa.array(cut, pa.large_string())
        nth = np.cumsum(pc.starts_with(joint, " ").to_numpy(zero_copy_only=False)) - 1
        single = [self.pattern.findall(" " + c) for c in chunks.filter(pa.array(alone)).to_pylist()]
        owner = np.concatenate([np.flatnonzero(~alone)[nth], np.repeat(np.flatnonzero(alone), list(map(len, single)))])
        pieces = pa.concat_arrays([joint, _flat(single)])
        return np.bincount(owner, minlength=len(chunks)), pieces.take(pa.array(np.argsort(owner, kind="stable")))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        given = pa.array(texts, pa.large_string())
        unsafe = pc.match_substring_regex(given, UNSAFE)
        split = pc.split_pattern(given.filter(pc.invert(unsafe)), " ")
        starts = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        codes[starts[:-1]] += len(coded.dictionary)  # at the start of a text, without a space before
        used = np.zeros(2 * len(coded.dictionary), bool)
        used[codes] = True
        codes = (np.cumsum(used) - 1)[codes]
        later, first = (coded.dictionary.filter(pa.array(u)) for u in np.split(used, 2))
        letters = pc.utf8_is_alpha(later).to_numpy(zero_copy_only=False)
        words, other = later.filter(pa.array(letters)), later.filter(pa.array(~letters))
        if len(self.first) + len(self.later) > KNOWN_CHUNKS:
            self.first, self.later = self.first.only(first), self.later.only(other)

        # The ids of words, of chunks not yet known, and of texts that are cut whole.
        later_place, first_place = self.later.places(other), self.first.places(first)
        new_later, new_first = other.filter(pa.array(later_place < 0)), first.filter(pa.array(first_place < 0))
        counts, pieces = self._cut(new_later)
        single = list(map(self.pattern.findall, [*new_first.to_pylist(), *given.filter(unsafe).to_pylist()]))
        counts = np.concatenate([np.ones(len(words), np.int64), counts, np.array(list(map(len, single)), np.int64)])
        pieces = pa.concat_arrays([_behind_space(words), pieces, _flat(single)]).dictionary_encode()
        places = self._learn(pieces.dictionary)[pieces.indices.to_numpy()]
        sizes, ids = _taken(self.pieces.sizes, self.pieces.ids, places)
        sizes = _run_sums(sizes, counts)
        ends = np.append(0, np.cumsum(sizes))

        # Chunks are looked up in one row of tables: the ids just found, chunks known after a space, those of starts.
        tables = [Known(None, sizes, ids), self.later, self.first]
        before = np.cumsum([0, len(sizes), len(self.later)])
        first_new = len(words) + len(new_later)
        found = np.empty(len(later) + len(first), np.int64)
        found[np.flatnonzero(letters)] = np.arange(len(words))
        found[np.flatnonzero(~letters)] = _placed(later_place, before[1], len(words))
        found[len(later):] = _placed(first_place, before[2], first_new)
        safe_sizes, safe_ids = _taken(
            np.concatenate([t.sizes for t in tables]), np.concatenate([t.ids for t in tables]), found[codes])
        for known, keys, at in ((self.later, new_later, len(words)), (self.first, new_first, first_new)):
            known.add(keys, sizes[at:at + len(keys)], ids[ends[at]:ends[at + len(keys)]])

        whole = _bytes_between(ids, ends[first_new + len(new_first):])
        safe = _bytes_between(safe_ids, np.append(0, np.cumsum(safe_sizes))[starts])
        return [next(whole if is_unsafe else safe) for is_unsafe in unsafe.to_pylist()]

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        out: list[bytes] = []
        for part in _by_size(encoded, TOKENS_PER_QUERY * 4):
            counts = [len(e) // 4 for e in part]
            ids = np.frombuffer(b"".join(part), "<u4").astype(np.int64)
            tokens = pa.table({
                "doc": np.repeat(np.arange(len(part)), counts), "place": np.arange(len(ids)), "id": ids})
            self.db.register("tokens", tokens)
            found = dict(self.db.sql(DECODE).fetchall())
            self.db.unregister("tokens")
            out += [found.get(i, "").encode("latin-1") for i in range(len(part))]
        return out


def _taken(sizes: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ids at these places, one after the other, and their sizes."""
    begins, taken = (np.cumsum(sizes) - sizes)[places], sizes[places]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    return taken, ids[np.arange(total) + np.repeat(begins - (ends - taken), taken)]


def _run_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of so many values, 0 for empty runs."""
    sums = np.append(0, np.cumsum(values))
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def _placed(places: np.ndarray, before: int, new: int) -> np.ndarray:
    """Places behind so many others; those that are not known stand in order from ``new`` on."""
    unknown = places < 0
    return np.where(unknown, new + np.cumsum(unknown) - 1, before + places)


def _bytes_between(ids: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
    return (ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))


def _flat(lists: list[list[str]]) -> pa.Array:
    return pa.array(list(chain.from_iterable(lists)), pa.large_string())


def _behind_space(strings: pa.Array) -> pa.Array:
    empty, space = (pa.scalar(c, pa.large_string()) for c in ("", " "))
    return pc.binary_join_element_wise(space, strings, empty)


def _bytes_of(strings: pa.Array) -> np.ndarray:
    """All bytes of an array of large strings without nulls, in order."""
    _, offsets, data = strings.buffers()
    bounds = np.frombuffer(offsets, np.int64)[strings.offset:strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]


def _is_text(token: bytes) -> bool:
    try:
        return bool(token.decode())
    except UnicodeDecodeError:
        return False


def _by_size(values: list, most: int) -> Iterator[list]:
    """Consecutive values of together at most so many characters or bytes, one at least."""
    part, size = [], 0
    for value in values:
        if part and size + len(value) > most:
            yield part
            part, size = [], 0
        part.append(value)
        size += len(value)
    if part:
        yield part


def encode_texts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                 keep_ids: bool = False) -> DataFrame:
    """Key, number of ids, digests of the ids and of the decoded bytes, and the ids if wanted."""
    taken = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    content = sent(docs.sparkSession, vocabulary)

    def rows(machine: ByteBpe, given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            at = 0
            texts = ((v.as_py() or "") for v in batch.column(1))
            for part in _by_size_lazily(texts):
                encoded = machine.encode(part)
                decoded = machine.decode(encoded)
                columns = [
                    batch.column(0).slice(at, len(part)),
                    pa.array([len(e) // 4 for e in encoded], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in encoded], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                ]
                names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.array(encoded, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at += len(part)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = built(ByteBpe, content.value)
        try:
            yield from rows(machine, given)
        finally:
            machine.rest()

    kind = taken.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return taken.mapInArrow(batches, schema + (", ids binary" if keep_ids else "")).withColumnRenamed("key", key)


def _by_size_lazily(texts: Iterator[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= CHARS_PER_ROUND:
            yield part
            part, size = [], 0
    if part:
        yield part
