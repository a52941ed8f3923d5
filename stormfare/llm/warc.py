"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing is a text write whose line separator is the end of a record. Reading
splits the files at the magic line, wherever it stands: each piece is a
candidate record, and its header's Content-Length gives its successor's offset.
A page may hold the magic line, or a whole record, so candidates prove nothing.
Only those on the chain that starts at offset 0 of the file are records.

The chain is followed by pointer jumping. Tasks first contract the pointers
within each block of a file, then the remaining pointers, from block to block,
are doubled until no new offset is reached: the rounds grow with the logarithm
of the blocks of the longest file. Tables between rounds go to the shared
folder. A payload that holds the magic line is put together from its pieces.

Defined results: null payloads are empty; a null key gives a record without a
page number; pages with equal keys and payloads are all of one type; an empty
table writes no records; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stormfare.llm.text import only, whole_text
from stormfare.session import scratch_path, written

MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
MIN_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"


def record_types(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Adds payload, digest, size, ``record_type`` and ``refers_to``.

    Only digests that occur twice are joined: a table as large as the copies,
    which is broadcast where its written size allows.
    """
    taken = pages.withColumn("_payload", whole_text(html))
    taken = taken.withColumns({
        "_digest": F.sha2(F.col("_payload"), 256),
        "_bytes": F.octet_length("_payload").cast("long"),
    })
    copies = written(
        taken.filter(F.col("_bytes") >= MIN_REVISIT_BYTES)
        .groupBy("_digest").agg(F.min(f"`{key}`").alias("_first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n"),
        "warc-copies",
    )
    joined = taken.join(copies, "_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col(f"`{key}`").eqNullSafe(F.col("_first"))
    return joined.withColumns({
        "record_type": F.when(revisit, "revisit").otherwise("response"),
        "refers_to": F.when(revisit, F.col("_first")),
    })


def write_archives(pages: DataFrame, path: str, key: str = "page_id", html: str = "html",
                   url: str = "url") -> None:
    """One record per row, in as many files as the write has tasks."""
    df = record_types(only(pages, *dict.fromkeys((key, html, url))), key, html)

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def page(value: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))

    is_revisit = F.col("record_type") == "revisit"
    target = F.regexp_replace(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"[\r\n]", "")
    stored = F.when(is_revisit, F.lit("")).otherwise(F.col("_payload"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", page(F.col(f"`{key}`"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "_digest")),
        line("WARC-Payload-Length", F.col("_bytes").cast("string")),
        F.when(is_revisit, line("WARC-Refers-To", page(F.col("refers_to")))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length(stored).cast("string")),
        # Last, so that no URL can bring in a line that looks like one of the others.
        line("WARC-Target-URI", target),
        F.lit("\r\n"), stored,
    )
    df.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magic lines in file order: (file, block, piece, value)."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"),
        F.octet_length("value").cast("long").alias("piece_bytes"),
        "value",
    )


def _with_starts(pieces: DataFrame, blocks: DataFrame) -> DataFrame:
    """Adds ``start``, the offset of the magic line before each piece.

    A block holds at most ``spark.sql.files.maxPartitionBytes``, so its running
    sum fits a task; the blocks of a file are summed among themselves.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select(
        "file", "block", F.coalesce(F.sum("block_bytes").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("piece").rowsBetween(
        Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("piece_bytes") + len(MAGIC)).over(inside), F.lit(0))
    return (
        pieces.withColumn("_before", before).join(bases, ["file", "block"])
        .withColumn("start", F.col("base") + F.col("_before") - len(MAGIC)).drop("_before", "base")
    )


def _block_sizes(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("file", "block").agg(
        F.sum(F.col("piece_bytes") + len(MAGIC)).alias("block_bytes"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate record: offset, successor's offset, header fields, digest of its own bytes."""
    head = F.substring_index("value", RECORD_END, 1)

    def field(name: str, pattern: str) -> Column:
        return F.regexp_extract("head", rf"(?im)^{name}: *{pattern}\r?$", 1)

    def number(text: Column) -> Column:
        return F.when(text != "", text).cast("long")

    parsed = _pieces(spark, path).withColumn("head", head)
    parsed = parsed.withColumns({
        "header_bytes": F.octet_length("head").cast("long") + len(RECORD_END),
        "content_bytes": F.when(
            F.locate(RECORD_END, F.col("value")) > 0, number(field("Content-Length", r"(\d{1,18})"))),
    })
    whole = F.col("header_bytes") + F.col("content_bytes") <= F.col("piece_bytes")
    body = F.expr("substring(cast(value AS BINARY), int(header_bytes + 1), int(content_bytes))")
    pieces = written(parsed.select(
        "file", "block", "piece", "piece_bytes", "header_bytes", "content_bytes",
        F.lower(field("WARC-Type", r"(\w+)")).alias("record_type"),
        number(field("WARC-Record-ID", r"<urn:page:(-?\d+)>")).alias("page_id"),
        number(field("WARC-Refers-To", r"<urn:page:(-?\d+)>")).alias("refers_to"),
        field("WARC-Payload-Digest", r"sha256:([0-9a-f]{64})").alias("header_digest"),
        number(field("WARC-Payload-Length", r"(\d{1,18})")).alias("header_bytes_of_payload"),
        F.when(whole, F.sha2(body, 256)).alias("own_digest"),
    ), "warc-pieces")
    found = _with_starts(pieces, _block_sizes(pieces))
    return found.withColumn("next", F.when(F.col("start") >= 0, F.col("start") + len(MAGIC)
                            + F.col("header_bytes") + F.col("content_bytes") + len(RECORD_END)))


def _leave_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Where each candidate's chain first leaves its block."""
    rows = rows.sort_values("start", ignore_index=True)
    starts, exits = rows["start"].to_numpy(), rows["next"].to_numpy()
    at = np.searchsorted(starts, exits)
    inner = (at < len(starts)) & (starts[np.minimum(at, len(starts) - 1)] == exits) & (exits > starts)
    hop = np.where(inner, at, np.arange(len(starts)))
    while True:
        further = hop[hop]
        if (further == hop).all():
            break
        hop = further
    return pd.DataFrame({"file": rows["file"], "block": rows["block"], "start": starts, "leaves": exits[hop]})


def _on_chain(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a block that its entry offsets lead to."""
    rows = rows.sort_values("start", ignore_index=True)
    starts, exits = rows["start"].to_numpy(), rows["next"].to_numpy()
    kept = np.zeros(len(starts), bool)
    for entry in entries["start"]:
        i = int(np.searchsorted(starts, entry))
        while i < len(starts) and starts[i] == entry and not kept[i]:
            kept[i] = True
            entry = exits[i]
            i = int(np.searchsorted(starts, entry))
    return rows.loc[kept, ["file", "start"]]


def reachable(found: DataFrame) -> DataFrame:
    """(file, start) of the candidates on the chain from offset 0, by pointer jumping."""
    linked = found.filter("next IS NOT NULL").select("file", "block", "start", "next")
    exits = written(
        linked.groupBy("file", "block").applyInPandas(
            _leave_block, "file string, block long, start long, leaves long"),
        "warc-exits",
    )
    # Only offsets at which some chain enters a block matter from here on.
    entered = exits.select("file", F.col("leaves").alias("start")).distinct()
    first = exits.filter("start = 0").select("file", "start")
    jumps = written(
        exits.join(entered.union(first).distinct(), ["file", "start"])
        .select("file", "start", "leaves"), "warc-jumps")
    reached = written(first, "warc-reached")
    new = reached
    while True:
        # ``jumps`` leads 2^k blocks on; what it reaches from all offsets so far doubles them.
        ahead = jumps.select("file", "start", F.col("leaves").alias("_to"))
        known = jumps.select("file", F.col("start").alias("_to"))
        new = written(
            reached.join(ahead, ["file", "start"]).join(known, ["file", "_to"], "left_semi")
            .select("file", F.col("_to").alias("start"))
            .join(reached, ["file", "start"], "left_anti").distinct(),
            "warc-new")
        if new.isEmpty():
            break
        reached = written(reached.union(new), "warc-reached")
        second = jumps.select("file", F.col("start").alias("_to"), F.col("leaves").alias("_far"))
        # A chain that has left the file keeps its last pointer: it reaches nothing more.
        jumps = written(
            ahead.join(second, ["file", "_to"], "left")
            .select("file", "start", F.coalesce("_far", "_to").alias("leaves")), "warc-jumps")
    blocks = exits.select("file", "block", "start")
    entries = reached.join(blocks, ["file", "start"])
    return linked.groupBy("file", "block").cogroup(entries.groupBy("file", "block")).applyInPandas(
        _on_chain, "file string, start long")


def _spanning_digests(spark: SparkSession, path: str, found: DataFrame, records: DataFrame) -> DataFrame:
    """Digests of payloads that hold the magic line, from all pieces they reach over."""
    spans = written(
        records.filter(F.col("own_digest").isNull())
        .select("file", F.col("start").alias("owner"), "header_bytes", "content_bytes"), "warc-spans")
    if spans.isEmpty():
        return records.select("file", "start", F.lit(None).cast("string").alias("span_digest")).limit(0)
    files = spans.select("file").distinct()
    marked = found.select("file", "block", "start").join(files, "file", "left_semi").join(
        records.select("file", "start", F.col("start").alias("_own")), ["file", "start"], "left")
    # A piece belongs to the last record up to it in its block, else to the last one of the blocks before.
    inside = Window.partitionBy("file", "block").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.groupBy("file", "block").agg(F.max("_own").alias("_last")).select(
        "file", "block", F.max("_last").over(earlier).alias("_carried"))
    owners = marked.withColumn("_last", F.max("_own").over(inside)).join(carried, ["file", "block"]).select(
        "file", "start", F.coalesce("_last", "_carried").alias("owner"))
    again = _pieces(spark, path).join(files, "file", "left_semi")
    texts = _with_starts(again, _block_sizes(again)).select("file", "start", "value")
    parts = texts.join(owners, ["file", "start"]).join(spans, ["file", "owner"])
    whole = parts.groupBy("file", "owner", "header_bytes", "content_bytes").agg(
        F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("start", "value"))), lambda x: x["value"]
        ), MAGIC).alias("value"))
    body = F.expr("substring(cast(value AS BINARY), int(header_bytes + 1), int(content_bytes))")
    return whole.select("file", F.col("owner").alias("start"), F.sha2(body, 256).alias("span_digest"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``, payloads checked against their digests."""
    found = written(candidates(spark, path), "warc-candidates")
    records = written(found.join(reachable(found), ["file", "start"]), "warc-records")
    spans = _spanning_digests(spark, path, found, records)
    joined = records.join(spans, ["file", "start"], "left")
    stored = F.coalesce("own_digest", "span_digest")
    is_revisit = F.col("record_type") == "revisit"
    return joined.select(
        "file", "start", "page_id",
        F.when(is_revisit, F.col("header_bytes_of_payload")).otherwise(F.col("content_bytes"))
        .alias("payload_bytes"),
        F.when(is_revisit, F.col("header_digest")).otherwise(stored).alias("payload_digest"),
        "record_type", "refers_to",
        (is_revisit | (stored == F.col("header_digest"))).alias("intact"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
