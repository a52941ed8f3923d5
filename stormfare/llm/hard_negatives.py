"""Hard negatives of anchor vectors, by score bounds along spanning trees of anchors.

Components are rounded down to whole 256ths; a score is the whole inner product
of two such vectors. Anchors that lie close together are packed into trees of at
most ``TREE_ANCHORS``: the anchors are dealt into ranges of a fixed direction,
and each Arrow batch of a range is halved across its widest direction until the
parts are small enough; a part's minimum spanning tree has the shortest edges
there are. All rows are packed into blocks of about ``BLOCK_ROWS``.

A task holds one block and reads the trees one after the other. The root of a
tree is scored against the whole block. By Cauchy and Schwarz the score of a row
with a child lies within edge length times row norm of its score, or of the
bounds of its score, with the parent. Only rows whose bounds reach the wanted
window are scored again; the others hand their bounds down. That happens twice:

* for the first positives of an anchor, rows of its label whose upper bound
  reaches the last of as many lower bounds;
* then, with the positives known, rows of other labels whose bounds meet the
  score window of a positive and reach the last of as many rows that surely lie
  in it.

Each block gives its best few per anchor or per anchor and positive, and the best
of these over all blocks are the result. Every anchor meets every block, as the
search of a stated set of rows against all rows does, so the trees, not the rows,
are repeated for each block.

Defined results: rows without id, label or vector, or with a null or non-finite
component, take no part; equal rows count once; a row never serves an anchor of
its own id; vectors of different length never meet; equal scores are ordered by
id, then by a hash of the row; two anchors of one id with different content have
results of their own; components whose 256-fold is not below 2**24 in size are an
error, as their scores might not be exact; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stormfare.session import written

SCALE = 256
LIMIT = 1 << 24
ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: The score window as shares of the positive's score, in percent.
LOWEST_PERCENT, HIGHEST_PERCENT = 50, 95
TREE_ANCHORS = 64
BLOCK_ROWS = 8_192
RANGE_ANCHORS = 4_096
SEED = 12


def usable_rows(vectors: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """(id, label, size, row, vector) of the rows that take part; ``row`` is a hash of the content."""
    taken = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("raw"))
    bad = F.exists("raw", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    known = taken.filter("id IS NOT NULL AND label IS NOT NULL AND raw IS NOT NULL").filter(~F.coalesce(bad, F.lit(False)))
    whole = known.withColumn("raw", F.transform("raw", lambda v: F.floor(v * float(SCALE)).cast("int")))
    return whole.select(
        "id", "label", F.size("raw").alias("size"), F.xxhash64("id", "label", "raw").alias("row"),
        F.col("raw").alias("vector")).dropDuplicates(["id", "label", "row", "vector"])


def _matrix(column, size: int) -> np.ndarray:
    """Whole numbers as doubles, whose products and sums are exact below 2**53."""
    flat = np.concatenate([np.asarray(v, float) for v in column]) if len(column) and size else np.zeros(0)
    found = flat.reshape(len(column), size)
    if np.abs(found).max(initial=0) >= LIMIT or (size and (np.abs(found).max(initial=0) ** 2) * size >= 2.0 ** 53):
        raise ValueError("components too large for exact scores")
    return found


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows in which parents come first, each one's parent, and its distance from it.

    The tree is the minimum spanning tree, from the row nearest to the middle; its parent is -1.
    """
    n = len(x)
    squares = (x * x).sum(axis=1)
    root = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    best, parent = np.full(n, np.inf), np.full(n, -1)
    best[root] = 0
    order, edges, out = [], np.zeros(n), np.ones(n, bool)
    for _ in range(n):
        own = int(np.argmin(np.where(out, best, np.inf)))
        order.append(own)
        edges[own] = best[own]
        out[own] = False
        gap = np.sqrt(np.maximum(squares + squares[own] - 2 * (x @ x[own]), 0))
        nearer = out & (gap < best)
        best[nearer], parent[nearer] = gap[nearer], own
    return np.array(order, np.int64), parent, edges


def _leaves(x: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Rows halved across their widest direction until few enough are left."""
    if len(rows) <= TREE_ANCHORS:
        yield rows
        return
    own = x[rows] - x[rows].mean(axis=0)
    along = own[int(np.argmax((own * own).sum(axis=1)))]
    order = np.argsort(own @ along, kind="stable")
    yield from _leaves(x, rows[order[:len(rows) // 2]])
    yield from _leaves(x, rows[order[len(rows) // 2:]])


_TREE = "size int, n int, ids array<long>, rows array<long>, labels array<long>, vectors binary, parents array<int>, edges array<double>"


def _planted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each tree of a batch of anchors, the anchors in an order in which parents come first."""
    for batch in batches:
        out = []
        for size, part in batch.groupby("size"):
            x = _matrix(part["vector"].to_list(), int(size))
            ids, rows, labels = (part[c].to_numpy(np.int64) for c in ("id", "row", "label"))
            for leaf in _leaves(x, np.arange(len(part))):
                order, parent, edges = spanning_tree(x[leaf])
                place = np.argsort(order)
                parents = np.where(parent[order] < 0, -1, place[parent[order]])
                own = leaf[order]
                out.append((int(size), len(own), ids[own].tolist(), rows[own].tolist(), labels[own].tolist(),
                            x[own].astype("<f8").tobytes(), parents.tolist(), edges[order].tolist()))
        yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in _TREE.split(", ")])


def anchor_trees(anchors: DataFrame, count: int) -> DataFrame:
    """Anchors packed into trees: neighbours by a fixed direction, then by their own widest ones."""
    # A fixed direction of any length: cosines of the places.
    along = F.aggregate(
        F.transform("vector", lambda v, i: v * F.cos(i * 2.399963 + SEED)), F.lit(0.0), lambda s, v: s + v)
    dealt = anchors.withColumn("along", along).repartitionByRange(
        max(1, -(-count // RANGE_ANCHORS)), "size", "along", "row")
    trees = dealt.sortWithinPartitions("size", "along", "row").select("id", "row", "label", "size", "vector")
    planted = trees.mapInPandas(_planted, _TREE)
    return planted.withColumn("tree", F.concat_ws("-", F.col("ids")[0], F.col("rows")[0], "size"))


def packed_blocks(rows: DataFrame, count: int) -> DataFrame:
    """All rows in blocks, one row for each: bounded, for rows are dealt by the hash of their content."""
    blocks = max(1, -(-count // BLOCK_ROWS))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "row"])
        size = int(part["size"].iloc[0])
        x = _matrix(part["vector"].to_list(), size)
        return pd.DataFrame({
            "block": [part["block"].iloc[0]], "size": [size], "ids": [part["id"].tolist()],
            "labels": [part["label"].tolist()], "rows": [part["row"].tolist()], "vectors": [x.astype("<i4").tobytes()]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block", "size").applyInPandas(
        pack, "block int, size int, ids array<long>, labels array<long>, rows array<long>, vectors binary")


class Block:
    """Rows of one block, by id, with their norms."""

    def __init__(self, row: dict):
        self.ids = np.array(row["ids"], np.int64)
        self.labels = np.array(row["labels"], np.int64)
        self.rows = np.array(row["rows"], np.int64)
        self.x = np.frombuffer(row["vectors"], "<i4").reshape(len(self.ids), row["size"]).astype(float)
        self.norms = np.sqrt((self.x * self.x).sum(axis=1)) * (1 + 1e-9)

    def best(self, chosen: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """The first rows by score, then by id."""
        order = np.lexsort((self.rows[chosen], self.ids[chosen], -scores[chosen]))[:most]
        return chosen[order]


class Walk:
    """Scores of a tree's anchors with a block, or bounds of them, parents first."""

    def __init__(self, block: Block, tree: dict):
        self.block, self.tree = block, tree
        self.anchors = np.frombuffer(tree["vectors"], "<f8").reshape(tree["n"], tree["size"])
        last = {parent: i for i, parent in enumerate(tree["parents"])}
        self.last_child = [last.get(i, -1) for i in range(tree["n"])]
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def bounds(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        parent = self.tree["parents"][i]
        if parent < 0:
            scores = self.block.x @ self.anchors[i]
            self.scored += len(scores)
            return scores, scores.copy()
        low, high = self.held[parent]
        reach = self.tree["edges"][i] * self.block.norms + 1e-3
        if self.last_child[parent] == i:
            del self.held[parent]
        return low - reach, high + reach

    def score(self, i: int, low: np.ndarray, high: np.ndarray, needed: np.ndarray) -> None:
        """Replaces the bounds of the needed rows by their scores."""
        needed = needed[low[needed] != high[needed]]
        self.scored += len(needed)
        if 2 * len(needed) > len(low):
            low[:] = high[:] = self.block.x @ self.anchors[i]
        elif len(needed):
            low[needed] = high[needed] = self.block.x[needed] @ self.anchors[i]

    def keep(self, i: int, low: np.ndarray, high: np.ndarray) -> None:
        if self.last_child[i] >= 0:
            self.held[i] = low, high


def _reaching(low: np.ndarray, high: np.ndarray, rows: np.ndarray, sure: np.ndarray, most: int) -> np.ndarray:
    """Of ``rows`` those that may be among the first ``most``, as that many of ``sure`` rows bound them."""
    if len(sure) < most:
        return rows
    return rows[high[rows] >= np.partition(low[sure], -most)[-most]]


def positives_of(block: Block, tree: dict, most: int) -> Iterator[tuple]:
    """(anchor's place, row's id, row, score): the first rows of the anchor's label in this block."""
    walk = Walk(block, tree)
    for i in range(tree["n"]):
        low, high = walk.bounds(i)
        same = np.flatnonzero((block.labels == tree["labels"][i]) & (block.ids != tree["ids"][i]))
        near = _reaching(low, high, same, same, most)
        walk.score(i, low, high, near)
        walk.keep(i, low, high)
        for j in block.best(near, low, most):
            yield i, block.ids[j], block.rows[j], int(low[j])


def negatives_of(block: Block, tree: dict, most: int, lowest: int, highest: int) -> Iterator[tuple]:
    """(anchor's place, positive's place, row's id, row, score): the first rows of other labels in a window."""
    walk = Walk(block, tree)
    for i in range(tree["n"]):
        low, high = walk.bounds(i)
        other = (block.labels != tree["labels"][i]) & (block.ids != tree["ids"][i])
        # Scores are whole: 100 * score lies between the shares of the positive's score.
        windows = [(k, -(-lowest * s // 100), highest * s // 100) for k, s in enumerate(tree["scores"][i])]
        windows = [w for w in windows if w[1] <= w[2]]
        needed = []
        for _, least, greatest in windows:
            meets = np.flatnonzero(other & (high >= least) & (low <= greatest))
            sure = meets[(low[meets] >= least) & (high[meets] <= greatest)]
            needed.append(_reaching(low, high, meets, sure, most))
        if needed:
            walk.score(i, low, high, np.unique(np.concatenate(needed)))
        walk.keep(i, low, high)
        for (k, least, greatest), near in zip(windows, needed):
            inside = near[(low[near] >= least) & (low[near] <= greatest)]
            for j in block.best(inside, low, most):
                yield i, k, block.ids[j], block.rows[j], int(low[j])


def _searched(blocks: DataFrame, trees: DataFrame, count: int, search, names: list[str], schema: str) -> DataFrame:
    """Every tree against every block: a block comes first in its rows, then the trees one by one."""
    every = F.explode(F.sequence(F.lit(0), F.lit(max(0, count - 1))))
    both = blocks.select(
        "block", "size", F.lit("").alias("tree"), F.struct("size", "ids", "labels", "rows", "vectors").alias("held"),
    ).unionByName(trees.select(
        every.alias("block"), "size", "tree", F.struct(*names).alias("asked")), allowMissingColumns=True)
    together = both.repartition("block", "size").sortWithinPartitions("block", "size", "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                row = batch.column("held")[k].as_py()
                if row is not None:
                    held = batch.column("block")[k].as_py(), row["size"], Block(row)
                    continue
                place = batch.column("block")[k].as_py(), batch.column("size")[k].as_py()
                if held is None or held[:2] != place:
                    continue  # no row of this length lies in this block
                name, tree = batch.column("tree")[k].as_py(), batch.column("asked")[k].as_py()
                found += ((name, *hit) for hit in search(held[2], tree))
            columns = [c.split(" ") for c in schema.split(", ")]
            values = list(zip(*found)) if found else [[] for _ in columns]
            kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kinds[kind]) for v, (_, kind) in zip(values, columns)], names=[n for n, _ in columns])

    return together.mapInArrow(run, schema)


def hard_negatives(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | None = None,
                   anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   lowest: int = LOWEST_PERCENT, highest: int = HIGHEST_PERCENT) -> DataFrame:
    """Anchor, positive, rank, negative and the two scores.

    ``label`` is an expression over ``vectors``; ``anchor`` is one over ``id``, the row's id.
    """
    rows = written(usable_rows(vectors, key, vector, F.col("label") if label is None else label), "negative-rows")
    asked = rows.filter(F.col("id") % ANCHOR_EVERY == 0 if anchor is None else anchor)
    total = rows.count()
    blocks = written(packed_blocks(rows, total), "negative-blocks")
    count = max(1, -(-total // BLOCK_ROWS))
    trees = written(anchor_trees(asked, asked.count()), "negative-trees")

    plain = ["size", "n", "ids", "labels", "vectors", "parents", "edges"]
    near = _searched(
        blocks, trees, count, lambda block, tree: positives_of(block, tree, positives), plain,
        "tree string, slot int, positive_id long, row long, score long")
    first = Window.partitionBy("tree", "slot").orderBy(F.desc("score"), "positive_id", "row")
    kept = written(
        near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives), "negative-positives")
    # At most TREE_ANCHORS times the positives of an anchor to a tree.
    scores = kept.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "score"))).alias("given"))
    slots = F.sequence(F.lit(0), F.col("n") - 1)
    own = F.transform(slots, lambda i: F.transform(
        F.filter("given", lambda g: g["slot"] == i), lambda g: g["score"]))
    aimed = written(trees.join(scores, "tree").withColumn("scores", own).drop("given"), "negative-aimed")
    hits = _searched(
        blocks, aimed, count, lambda block, tree: negatives_of(block, tree, negatives, lowest, highest),
        [*plain, "scores"], "tree string, slot int, positive int, negative_id long, row long, score long")
    best = Window.partitionBy("tree", "slot", "positive").orderBy(F.desc("score"), "negative_id", "row")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    anchors = trees.select("tree", F.posexplode("ids").alias("slot", "anchor_id"))
    return (
        ranked.join(
            kept.select("tree", "slot", (F.col("place") - 1).alias("positive"), "positive_id",
                        F.col("score").alias("positive_score")), ["tree", "slot", "positive"])
        .join(anchors, ["tree", "slot"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                F.col("score").alias("negative_score"))
    )
