"""Mixing sources to target weights by systematic sampling.

A source's documents all expect ``target / source size`` copies. Laid end to
end in a fixed order and shifted by one random offset per source, these
expectations cross an integer boundary now and then; each crossing emits the
document once. So a source's count is within one of what is expected, and since
the order follows the size, so nearly are its words.

The running sum needs no task that holds a whole source: documents are ranked
within cells of (source, size class, hash bucket), and a cell starts where the
counts of the cells before it end. Cells are at most sources x size classes x
``BUCKETS``; they are counted first and written to the shared folder.

Defined results: null text has size 0; a null source is a source of its own and
comes last; documents without words are never taken; rows that are equal in
every column are interchangeable; a table without words takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stormfare.llm.text import only, whole_text, word_count
from stormfare.session import written

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKETS = 64
SEED = 17


def _with_cell(docs: DataFrame, key: str, text: str, source: str, tie: Column) -> DataFrame:
    """``_row`` and what ranks it: size, cell and the order within the cell."""
    df = docs.withColumns({
        "_size": word_count(whole_text(text)),
        # A key without nulls: windows and joins on it share one partitioning.
        "_source": F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`")), F.lit("~")),
        "_id": F.col(f"`{key}`"),
        "_tie": tie,
    })
    bits = F.length(F.bin(F.col("_size")))
    digest = F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")))
    return df.withColumns({
        # Eight classes to a doubling of the size.
        "_class": bits * 16 + F.expr("shiftright(_size, greatest(length(bin(_size)) - 4, 0))").cast("int"),
        "_bucket": (F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % BUCKETS),
    })


def source_targets(sources: DataFrame) -> DataFrame:
    """Targets of sources (_source, docs, words): shares by weight, none above its limit.

    Sorted by how soon the limit is reached, the sources at their limit come
    first; the others share what is left by weight. One row per source.
    """
    everything = Window.partitionBy()
    number = F.row_number().over(Window.orderBy("_source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((number - 1) % len(WEIGHTS)) + 1)
    df = sources.withColumn("weight", weight)
    df = df.withColumn("_reach", F.col("words") / F.col("weight"))
    before = Window.orderBy("_reach", "_source").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("_reach", "_source").rowsBetween(0, Window.unboundedFollowing)
    df = df.withColumns({
        "_left": F.sum("words").over(everything)
        - MAX_COPIES * F.coalesce(F.sum("words").over(before), F.lit(0)),
        "_weights": F.sum("weight").over(onward),
    })
    df = df.withColumn(
        "_full", MAX_COPIES * F.col("words") * F.col("_weights") <= F.col("_left") * F.col("weight")
    )
    df = df.withColumns({
        "_rest": F.sum("words").over(everything)
        - F.sum(F.when(F.col("_full"), MAX_COPIES * F.col("words")).otherwise(0)).over(everything),
        "_open": F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(everything),
    })
    shared = F.col("_rest").cast("double") * F.col("weight") / F.col("_open")
    target = F.when(F.col("_full"), (MAX_COPIES * F.col("words")).cast("double")).otherwise(shared)
    return df.select("_source", F.col("words").alias("source_size"), target.alias("target"))


def _offset(seed: int) -> Column:
    """The random offset of a source, the same in every run with the same seed."""
    name = F.concat(F.lit(f"{seed}:"), F.col("_source"))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def with_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                seed: int = SEED, tie: Column | None = None) -> DataFrame:
    """Adds ``_size``, ``source_size``, ``target`` and ``_copies`` to every row of ``docs``."""
    tie = F.lit(0) if tie is None else tie
    spread = _with_cell(docs, key, text, source, tie)
    cells = written(
        _with_cell(only(docs, *dict.fromkeys((key, text, source))), key, text, source, F.lit(0))
        .groupBy("_source", "_class", "_bucket")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("_size").alias("words")),
        "mixing-cells",
    )
    targets = source_targets(cells.groupBy("_source").agg(F.sum("words").alias("words")))
    earlier = Window.partitionBy("_source").orderBy("_class", "_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = cells.withColumn("_start", F.coalesce(F.sum("docs").over(earlier), F.lit(0)))
    starts = starts.select("_source", "_class", "_bucket", "_start").join(targets, "_source")

    inside = Window.partitionBy("_source", "_class", "_bucket").orderBy("_size", "_id", "_tie")
    ranked = spread.withColumn("_rank", F.row_number().over(inside))
    ranked = ranked.join(starts, ["_source", "_class", "_bucket"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("_start") + F.col("_rank")
    crossed = F.floor(_offset(seed) + rate * place) - F.floor(_offset(seed) + rate * (place - 1))
    return ranked.withColumn(
        "_copies", F.when(F.col("_size") > 0, F.least(crossed, F.lit(MAX_COPIES))).otherwise(0)
    )


def mixing_report(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  source: str = "source", seed: int = SEED) -> DataFrame:
    """What the mix takes of every document."""
    df = with_copies(only(docs, *dict.fromkeys((key, text, source))), key, text, source, seed)
    return df.select(
        F.col("_id").alias(key), F.col("_size").alias("size"), "source_size", "target",
        (F.col("_copies") * F.col("_size")).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, all its columns as they were."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    packed = docs.select(
        F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t"), F.col(f"`{source}`").alias("_s"),
        F.struct(*columns).alias("_row"), F.xxhash64(*columns).alias("_hash"),
    )
    df = with_copies(packed, "_k", "_t", "_s", seed, F.col("_hash"))
    once = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))
    return df.select("_row", once.alias("_copy")).select("_row.*")
