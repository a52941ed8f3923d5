"""A prefix trie of rebuilt conversations, by composable fingerprints of turn sequences.

A rebuilt conversation is the first turns of a base conversation, its head, and
then its own turns behind as many. No rebuilt text is made: turns are numbered
and stored once as references with two 64-bit hashes, and a sequence has the
fingerprint of a monoid. The fingerprint of turns s1 … sn is the sum of
``s_i * m**(n - i)`` modulo a prime, and that of two sequences one behind the
other is ``f(a) * m**len(b) + f(b)``. So a head is fingerprinted once for its
base and combined with the products of the own turns behind it. Own turns are
taken in runs of ``RUN_TURNS``, whose products are combined likewise, so one
conversation of any length fills many tasks.

Rows (conversation, depth, fingerprint) make the nodes. Equality is verified,
not assumed: turns of equal hashes must have equal texts, and all members of a
node the same last turn and the same parent's fingerprint, from which equality
of whole sequences follows by induction. If any fails, all is made anew with
another seed.

Sums over subtrees need no walk through the levels. Each node belongs to its
smallest member, and each member of a node hands up the total of what belongs to
it: that is the subtree, but for nodes above on the path of the node's own
smallest member, which are taken off by a running sum.

Members that end in a node are sorted over ranges, joined to pieces of text and
then hashed piece by piece, so no task holds a group.

Defined results: null roles and texts are empty; turns without a conversation
take no part; equal turn numbers are ordered by the hash of their content;
repeated rows are turns of their own; no conversations, no nodes; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stormfare.operators.numbering import with_row_number
from stormfare.session import written

PRIME = (1 << 127) - 1
BASE_EVERY = 100
#: Heads have fewer turns than this.
HEAD_KINDS = 6
RUN_TURNS = 4_096
IDS_PER_PIECE = 20_000
#: So many pairs of hashes, 16 bytes each, are broadcast at most.
BROADCAST_ROWS = 1_000_000
SEEDS = 4

_LOW = (1 << 64) - 1
NODE = ["depth", "hi", "lo"]


def multiplier(seed: int) -> int:
    return int.from_bytes(hashlib.sha256(f"turns {seed}".encode()).digest()[:15], "big") | 1


def turn_keys(seed: int) -> list[Column]:
    """Two hashes of a turn's role and text."""
    return [F.xxhash64(F.lit(2 * seed), "role", "text").alias("k1"),
            F.xxhash64(F.lit(2 * seed + 1), "text", "role").alias("k2")]


def _symbol(k1: int, k2: int) -> int:
    return (((k1 & _LOW) << 64) | (k2 & _LOW)) % PRIME


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _halves(f: int) -> tuple[int, int]:
    return f >> 64, _signed(f & _LOW)


def _whole(hi: int, lo: int) -> int:
    return (hi << 64) | (lo & _LOW)


def _small(df: DataFrame) -> DataFrame:
    """A written table of keys, marked for broadcast if its row count allows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def turns_differ(given: DataFrame) -> bool:
    """Whether turns of equal hashes differ in role or text; only texts of repeated hashes are moved."""
    repeated = written(
        given.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k1", "k2"), "trie-repeated")
    texts = given.join(_small(repeated), ["k1", "k2"]).groupBy("k1", "k2")
    ends = texts.agg(F.min(F.struct("role", "text")).alias("a"), F.max(F.struct("role", "text")).alias("b"))
    return not ends.filter("a <> b").isEmpty()


def _head_products(m: int):
    """Fingerprints of all prefixes of a conversation's head, the empty one included."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for head in batch.column("head").to_pylist():
                f, made = 0, [{"hi": 0, "lo": 0}]
                for turn in head:
                    f = (f * m + _symbol(turn["k1"], turn["k2"])) % PRIME
                    made.append(dict(zip(("hi", "lo"), _halves(f))))
                out.append(made)
            kind = pa.list_(pa.struct([("hi", pa.int64()), ("lo", pa.int64())]))
            yield batch.append_column("products", pa.array(out, kind))

    return products


def _run_products(m: int):
    """Products along each run of turns, from the product the run starts with; also the product before each turn."""
    names = ["conv", "run", "place", "hi", "lo", "before_hi", "before_lo"]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, f = None, 0
        for batch in batches:
            out = []
            for conv, run, place, k1, k2, hi, lo in _columns(batch):
                if (conv, run) != last:
                    last, f = (conv, run), _whole(hi, lo)
                before, f = f, (f * m + _symbol(k1, k2)) % PRIME
                out.append((conv, run, place, *_halves(f), *_halves(before)))
            yield _batch(out, names)

    return products, ", ".join(f"{n} long" for n in names)


def _run_starts(m: int):
    """Where each run but the first starts: the head, then the products of the runs before."""
    step = pow(m, RUN_TURNS, PRIME)

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, f = None, 0
        for batch in batches:
            out = []
            for conv, run, hi, lo, head_hi, head_lo in _columns(batch):
                if conv != last:
                    last, f = conv, _whole(head_hi, head_lo)
                f = (f * step + _whole(hi, lo)) % PRIME
                out.append((conv, run + 1, *_halves(f)))
            yield _batch(out, ["conv", "run", "start_hi", "start_lo"])

    return starts, "conv long, run long, start_hi long, start_lo long"


def _own_products(own: DataFrame, m: int) -> DataFrame:
    """(conv, place, hi, lo, before_hi, before_lo) of own turns (conv, place, k1, k2, head_hi, head_lo, behind)."""
    along, schema = _run_products(m)
    cut = own.withColumn("run", F.floor(F.col("place") / RUN_TURNS))

    def through(rows: DataFrame, hi: Column, lo: Column) -> DataFrame:
        dealt = rows.select("conv", "run", "place", "k1", "k2", hi, lo).repartition("conv", "run")
        return dealt.sortWithinPartitions("conv", "run", "place").mapInArrow(along, schema)

    # The product of a whole run is that up to its last turn, from nothing.
    long_ = cut.filter(F.col("behind") > RUN_TURNS)
    nothing = F.lit(0).cast("long")
    whole = through(long_, nothing.alias("start_hi"), nothing.alias("start_lo")).filter(
        (F.col("place") + 1) % RUN_TURNS == 0)
    heads = long_.filter("place = 0").select("conv", "head_hi", "head_lo")
    chained, chained_schema = _run_starts(m)
    starts = whole.select("conv", "run", "hi", "lo").join(heads, "conv").repartition("conv").sortWithinPartitions(
        "conv", "run").mapInArrow(chained, chained_schema)
    started = cut.join(written(starts, "trie-runs"), ["conv", "run"], "left")
    return through(started, F.coalesce("start_hi", "head_hi").alias("start_hi"),
                   F.coalesce("start_lo", "head_lo").alias("start_lo"))


def _paths(given: DataFrame, base: Column, head: Column, m: int) -> DataFrame:
    """One row per rebuilt conversation and depth: the node, its parent, the last turn, and the whole length."""
    order = ["conv", "known", "turn", "k1", "k2"]
    numbered = written(
        with_row_number(given.select(*order, "chars"), order, "ref").drop("known", "turn"), "trie-turns")
    convs = numbered.groupBy("conv").agg(F.min("ref").alias("first"), F.count(F.lit(1)).alias("turns"))
    convs = written(convs.withColumns({"base": base, "taken": head.cast("long")}), "trie-conversations")
    turns = numbered.join(convs, "conv").withColumn("place", F.col("ref") - F.col("first"))

    # Heads hold fewer turns than HEAD_KINDS.
    first_turns = turns.filter(F.col("place") < HEAD_KINDS - 1).join(
        convs.select(F.col("base").alias("conv")).distinct(), "conv", "left_semi")
    heads = first_turns.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("place", "k1", "k2", "chars"))).alias("all"))
    kept = F.filter(F.col("all"), lambda t: t["place"] < F.col("taken"))
    headed = convs.join(heads.withColumnRenamed("conv", "base"), "base", "left").select(
        "conv", "taken", "turns",
        F.coalesce(kept, F.expr("cast(array() AS array<struct<place: long, k1: long, k2: long, chars: long>>)")).alias("head"))
    starts = headed.mapInArrow(
        _head_products(m), "conv long, taken long, turns long, "
        "head array<struct<place: long, k1: long, k2: long, chars: long>>, products array<struct<hi: long, lo: long>>")
    starts = written(starts.withColumns({
        "behind": F.greatest(F.col("turns") - F.col("taken"), F.lit(0)),
        "in_head": F.size("head").cast("long"),
    }).withColumn("length", F.col("in_head") + F.col("behind")), "trie-heads")

    within = F.col("depth") > 0

    def when_within(value: Column) -> Column:
        return F.when(within, value).otherwise(0)

    in_head = starts.select("conv", "length", "head", "products", F.posexplode("products").alias("depth", "own"))
    in_head = in_head.select(
        "conv", F.col("depth").cast("long").alias("depth"), F.col("own.hi").alias("hi"), F.col("own.lo").alias("lo"),
        *(when_within(F.try_element_at("products", F.col("depth")).getField(c)).alias(f"before_{c}") for c in ("hi", "lo")),
        *(when_within(F.try_element_at("head", F.when(within, F.col("depth")).otherwise(1)).getField(c)).alias(c)
          for c in ("k1", "k2", "chars")),
        "length")
    ends = starts.filter("behind > 0").select(
        "conv", "taken", "behind", "in_head", "length", F.element_at("products", -1).alias("end"))
    own = numbered.join(convs.select("conv", "first"), "conv").join(ends, "conv").withColumn(
        "place", F.col("ref") - F.col("first") - F.col("taken")).filter("place >= 0")
    own = written(own.select("conv", "place", "k1", "k2", "chars", "behind", "in_head", "length",
                             F.col("end.hi").alias("head_hi"), F.col("end.lo").alias("head_lo")), "trie-own")
    behind = own.select("conv", "place", "k1", "k2", "chars", "in_head", "length").join(
        _own_products(own, m).drop("run"), ["conv", "place"])
    behind = behind.withColumn("depth", F.col("in_head") + F.col("place") + 1)
    return written(in_head.unionByName(behind.select(*in_head.columns)), "trie-paths")


def _ends(paths: DataFrame) -> DataFrame:
    """The digest of each node's members that end there."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def flushed() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_pydict({
                "depth": pa.array([node[0]], pa.int64()), "hi": pa.array([node[1]], pa.int64()),
                "lo": pa.array([node[2]], pa.int64()), "first": pa.array([ids[0]], pa.int64()), "text": [text]})

        for batch in batches:
            out = []
            for *own, conv in _columns(batch):
                if ids and (own != node or len(ids) >= IDS_PER_PIECE):
                    out.append(flushed())
                    ids = []
                node = own
                ids.append(conv)
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if ids:
            yield flushed()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def batch_of(rows: list) -> pa.RecordBatch:
            depth, hi, lo, text = list(zip(*rows)) if rows else [()] * 4
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in (depth, hi, lo)), pa.array(text, pa.string())],
                names=[*NODE, "ends_sha256"])

        for batch in batches:
            out = []
            for *own, _, text in _columns(batch):
                if own == node:
                    digest.update(b",")
                else:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256()
                digest.update(text.encode())
            yield batch_of(out)
        if node:
            yield batch_of([(*node, digest.hexdigest())])

    members = paths.filter("depth = length").select(*NODE, "conv")
    ranged = members.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    joined = written(
        ranged.mapInArrow(pieces, "depth long, hi long, lo long, first long, text string"), "trie-ends")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        digests, "depth long, hi long, lo long, ends_sha256 string")


def _nodes(paths: DataFrame) -> DataFrame | None:
    """One row per node, or None where two sequences share a fingerprint."""
    last = ["k1", "k2", "before_hi", "before_lo"]
    grouped = paths.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.max("chars").alias("chars"),
        *(agg(c).alias(f"{agg.__name__}_{c}") for c in last for agg in (F.min, F.max)))
    nodes = written(grouped, "trie-nodes")
    same = " AND ".join(f"min_{c} = max_{c}" for c in last)
    if not nodes.filter(f"NOT ({same})").isEmpty():
        return None
    return nodes.select(
        *NODE, "conv_id", "n_convs", F.col("min_before_hi").alias("parent_hi"), F.col("min_before_lo").alias("parent_lo"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", base: Column | None = None, head: Column | None = None) -> DataFrame:
    """One row per node: smallest member, depth, parent, members, children, leaves, saved tokens, digest of the ends.

    ``base`` and ``head``, expressions over ``conv``, are the conversation that the
    head comes from and its number of turns, below ``HEAD_KINDS``.
    """
    base = F.col("conv") - F.col("conv") % BASE_EVERY if base is None else base
    head = F.crc32(F.col("conv").cast("string")) % HEAD_KINDS if head is None else head
    taken = conversations.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))),
    ).filter("conv IS NOT NULL")
    for seed in range(SEEDS):
        given = taken.withColumns({
            "known": F.col("turn").isNotNull(), "chars": F.char_length("text").cast("long"),
            **dict(zip(("k1", "k2"), turn_keys(seed)))})
        if turns_differ(given):
            continue
        paths = _paths(given, base, head, multiplier(seed))
        nodes = _nodes(paths)
        if nodes is not None:
            return _measured(paths, nodes)
    raise RuntimeError(f"turns or prefixes that differ share fingerprints under {SEEDS} seeds")


def _measured(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes with their parents, children and sums over subtrees."""
    below = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")).agg(
        F.count(F.lit(1)).alias("n_children"))
    known = written(nodes.join(below, NODE, "left").na.fill(0, ["n_children"]), "trie-children")
    # What belongs to each conversation that is some node's smallest member.
    owners = known.groupBy(F.col("conv_id").alias("conv")).agg(
        F.sum("saved").alias("total"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    sums = paths.select("conv", *NODE).join(owners, "conv").groupBy(*NODE).agg(
        F.sum("total").alias("total"), F.sum("leaves").alias("n_leaves"))

    # Nodes of the same owner above each node, run by run.
    cut = known.select(*NODE, "conv_id", "saved", F.floor(F.col("depth") / RUN_TURNS).alias("run"))
    earlier = (Window.unboundedPreceding, -1)
    runs = cut.groupBy("conv_id", "run").agg(F.sum("saved").alias("in_run"))
    runs = runs.select("conv_id", "run", F.coalesce(
        F.sum("in_run").over(Window.partitionBy("conv_id").orderBy("run").rowsBetween(*earlier)), F.lit(0)).alias("before_run"))
    in_run = F.sum("saved").over(Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(*earlier))
    above = cut.withColumn("in_run", F.coalesce(in_run, F.lit(0))).join(runs, ["conv_id", "run"]).select(
        *NODE, (F.col("in_run") + F.col("before_run")).alias("above"))

    parents = known.select(
        (F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"),
        F.col("conv_id").alias("parent_conv_id"))
    measured = (
        known.join(sums, NODE).join(above, NODE).join(_ends(paths), NODE, "left")
        .join(parents, ["depth", "parent_hi", "parent_lo"], "left")
    )
    return measured.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("total") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
