"""Two-pass external shuffle: scatter into memory-sized buckets, Fisher-Yates shuffle each, write shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, keep_columns

#: Shuffle partitions of the scatter at most; from there on a partition holds several buckets, worked off one by one.
MAX_PARTS = 1 << 14
#: The table of bucket offsets (16 bytes a row) is broadcast up to so many buckets, and joined beyond.
BROADCAST_BUCKETS = 1 << 20


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shuffled_shards(
    df: DataFrame, n_shards: int, seed: int = 0, bucket_bytes: int = 8 << 20, row_bytes: Column | int = 64
) -> DataFrame:
    """The rows of ``df`` in random order, cut into ``n_shards`` equal runs: adds ``shard`` and ``slot``.

    Pass 1 scatters rows into buckets of about ``bucket_bytes`` by a seeded hash of
    the row's place in the input.  Pass 2 draws a Fisher-Yates permutation of each
    bucket (``shuffle``) and writes the bucket to the checkpoint folder.  The
    buckets, one after the other, are the new order; shard counts differ by one at
    most, and each bucket feeds one or two neighbouring shards.

    ``df`` should be a table read from files or a checkpoint, so that a re-run task
    sees its rows in the same places.  Columns may hold nulls, ids may repeat: rows
    are told apart by place.  An input column named ``shard`` or ``slot`` is
    replaced.  An empty table gives no rows; fewer rows than shards leave some empty.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    size = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    total = df.agg(F.sum(size.cast("long")).alias("b")).first()["b"] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    kept = keep_columns(df, ["shard", "slot"])
    rows = df.select(F.monotonically_increasing_id().alias("place"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    scattered = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "place"), F.lit(n_buckets))).repartition(min(n_buckets, MAX_PARTS), "bucket")
    buckets = scattered.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("place", "row"))).alias("rows"))
    # places are unique, so this order and the permutation drawn from it come out the same in a re-run task
    mixed = buckets.sortWithinPartitions("bucket").select("bucket", F.shuffle("rows", F.lit(seed)).alias("rows"))
    written = cut(mixed.select("bucket", F.posexplode("rows").alias("i", "r")).select("bucket", "i", F.col("r.row").alias("row")))
    w = Window.orderBy("bucket")
    offsets = written.groupBy("bucket").agg(F.count("*").alias("n")).select(
        "bucket", (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all")
    )
    pos = F.col("before") + F.col("i")
    # whole-number division
    shard = F.expr(f"(before + i) * {n_shards} div `all`")
    first = F.expr(f"(shard * `all` + {n_shards - 1}) div {n_shards}")
    return (
        written.join(F.broadcast(offsets) if n_buckets <= BROADCAST_BUCKETS else offsets, "bucket")
        .withColumn("shard", shard.cast("int")).withColumn("slot", pos - first)
        .select(*[F.col(f"row.`{c}`") for c in kept], "shard", "slot")
    )


def write_shards(shards: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per shard; a task writes few of them, because buckets are cut in order."""
    shards.write.mode(mode).partitionBy("shard").parquet(path)


def shard_digest(documents: DataFrame, n_shards: int = 16, seed: int = 20) -> DataFrame:
    """Shard and slot of every document, law ``rows``, from the whole shuffled rows; a null text has a null checksum."""
    rows = shuffled_shards(documents.select("doc_id", "text"), n_shards, seed, row_bytes=text_bytes(F.col("text")) + 64)
    return rows.select(
        "doc_id", text_bytes(F.col("text")).alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
