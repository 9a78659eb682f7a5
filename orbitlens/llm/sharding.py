"""Sharding by a two-pass external shuffle that any cluster repeats.

Pass one scatters the records uniformly into memory-sized buckets by a seeded hash of the record and writes them to
the shared folder. Pass two shuffles each bucket by Fisher-Yates, drawing from a hash of (seed, bucket, step), and lays the
buckets end to end: the resulting global order is cut into shards whose row counts differ by one at most (law
``rows``). Number and size of buckets follow the table alone, and so do all draws, so equal tables give equal shards
whatever their files, partitions or settings.

Equal records share their hash. A record that occurs more often than ``HOT`` times is numbered first (by its place in
the written copy: equal records may be exchanged), and the number takes part in the hash, so that the copies spread
over all buckets. The engine chooses how to join the list of such records, and splits a hot key where it is large.

Defined cases: null text has size 16 and CRC 0; repeated rows are records of their own; very long texts make no more
than one row of a bucket; rows that tie in all columns are told apart by nothing, so any of them may stand in any of
their places; an empty table gives no rows; input columns named like an output column are replaced, and no other
column is touched, whatever its name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.session import materialize

BUCKET_BYTES = 64 << 20
#: rows a bucket has on average at most: the steps of its shuffle copy it once each
BUCKET_ROWS = 2048
MIN_BUCKETS = 64
#: copies of a record that go by their hash alone
HOT = 256
ROW_BYTES = 16


def with_sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``size`` (bytes of the text and 16) and ``text_crc32``."""
    plain = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({
        "size": (F.octet_length(plain) + ROW_BYTES).cast("long"), "text_crc32": F.crc32(plain.cast("binary")),
    })


def draw(seed: int, bucket: Column, step: Column, below: Column) -> Column:
    """A number from 0 to ``below`` (exclusive) that belongs to a bucket's step."""
    return F.pmod(F.xxhash64(F.lit(seed + 2), bucket, step), below).cast("int")


def permutation(seed: int, bucket: Column, n: Column) -> Column:
    """The positions 0..n-1 of a bucket as Fisher-Yates lays them out, from the inside."""
    def step(done: Column, i: Column) -> Column:
        j = draw(seed, bucket, i, i + 1)
        # the new position goes to place j, and what stood there to the end
        moved = F.concat(F.slice(done, F.lit(1), j), F.array(i), F.slice(done, j + 2, F.greatest(i - j - 1, F.lit(0))), F.array(F.get(done, j)))
        return F.when(j == i, F.concat(done, F.array(i))).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(1), n - 1), F.array(F.lit(0)), step)


def _numbered(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows with ``copy``: the number of a hot record's copy, else 0.

    Copies are numbered inside the partition that wrote them, and a partition's copies begin where those of
    the partitions before end, so a record of any number of copies is no single group.
    """
    part = F.shiftright("rid", 33)
    marked = rows.join(hot, "key", "left").withColumn("part", F.when(F.col("is_hot"), part))
    counts = marked.where("is_hot").groupBy("key", "part").agg(F.count("*").alias("n"))
    sofar = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("key", "part", F.coalesce(F.sum("n").over(sofar), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("key", "part").orderBy("rid"))
    copies = marked.where("is_hot").withColumn("n", inside).join(starts, ["key", "part"])
    copies = copies.select(*rows.columns, (F.col("first") + F.col("n")).cast("long").alias("copy"))
    return marked.where("is_hot is null").select(*rows.columns, F.lit(0).cast("long").alias("copy")).union(copies)


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 17, text: str = "text",
                        bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows with ``size``, ``text_crc32``, ``law``, ``shard`` and ``slot`` (gapless from 0 in the shard)."""
    names = ["size", "text_crc32", "law", "shard", "slot"]
    kept = [c for c in docs.columns if c not in names]
    columns = [F.col(f"`{c}`") for c in kept]
    made = with_sizes(docs, text).select(F.struct(*columns).alias("row"), "size", "text_crc32")
    # a second hash makes the order inside a bucket that of the records
    made = made.select("*", F.xxhash64(F.lit(seed), "row").alias("key"), F.xxhash64("row", F.lit(seed)).alias("other"),
                       F.monotonically_increasing_id().alias("rid"))
    written = materialize(made, "scatter")
    total = written.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    rows = total["rows"]
    n_buckets = max(math.ceil((total["bytes"] or 0) / bucket_bytes), math.ceil(rows / bucket_rows), MIN_BUCKETS)

    slim = written.select("rid", "key", "other")
    hot = slim.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key", F.lit(True).alias("is_hot"))
    # numbers only: what a row holds stays where it was written
    spread = F.when(F.col("copy") > 0, F.xxhash64(F.lit(seed + 1), "key", "copy")).otherwise(F.xxhash64(F.lit(seed + 1), "key"))
    dealt = _numbered(slim, hot).withColumn("bucket", F.pmod(spread, F.lit(n_buckets)))
    dealt = materialize(dealt, "dealt")

    counts = dealt.groupBy("bucket").agg(F.count("*").alias("n"))
    block = F.expr("bucket div 1024")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy(block.alias("block")).agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    within = Window.partitionBy(block).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "n", block.alias("block"), F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inner"))
    places = offsets.join(F.broadcast(blocks), "block").select(
        "bucket", (F.col("head") + F.col("inner")).alias("before"),
        F.when(F.col("n") > 1, permutation(seed, F.col("bucket"), F.col("n").cast("int"))).otherwise(F.array(F.lit(0))).alias("places"))
    local = F.row_number().over(Window.partitionBy("bucket").orderBy("key", "other", "copy", "rid"))
    at = F.col("before") + F.get("places", F.col("local") - 1)
    shard = F.expr(f"cast(at * {shards} div {max(rows, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {rows} + {shards - 1}) div {shards}")
    placed = (dealt.withColumn("local", local).join(places, "bucket").select("rid", at.alias("at"))
              .withColumn("shard", shard).select("rid", "shard", (F.col("at") - first).cast("long").alias("slot")))
    return written.join(placed, "rid").select(*[F.col("row")[c].alias(c) for c in kept], "size", "text_crc32",
                                              F.lit("rows").alias("law"), "shard", "slot")


def write_shards(sharded: DataFrame, path: str, runs: int = 8) -> None:
    """One folder per shard with ``runs`` files or fewer, each a run of slots in order, written by tasks of their own."""
    size = sharded.groupBy("shard").count().agg(F.max("count")).first()[0] or 1
    part = F.expr(f"slot div {max(1, math.ceil(size / runs))}")
    (sharded.withColumn("run", part).repartition("shard", "run").sortWithinPartitions("shard", "run", "slot").drop("run")
     .write.partitionBy("shard").mode("overwrite").parquet(path))
