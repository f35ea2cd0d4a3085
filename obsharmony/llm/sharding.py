"""Two-pass external shuffle into shards.

Pass one scatters records by a seeded hash into buckets that fit in memory; pass two
shuffles each bucket by Fisher-Yates (Spark's own `shuffle` function on the bucket's sorted
rows) and deals it out. The order over all buckets is a uniform shuffle of the table; its
positions go round the shards in turn, so shard sizes differ by one row at most.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BYTES = 32 << 20
#: Buckets whose row counts one window task adds up; blocks of buckets are added up again.
BLOCK = 1024


def shard(
    docs: DataFrame, shards: int = 16, seed: int = 20240229, bucket_bytes: int = BUCKET_BYTES, text: str = "text"
) -> DataFrame:
    """Every row with `size`, `shard` and `slot` (its place in the shard, gapless from 0).

    Law: rows; the counts of two shards differ by one at most. `size` is the UTF-8 bytes of
    the text plus one; a missing text has none. The bucket of a row follows from the seed and
    a hash of all its key columns, so copies with ids of their own spread evenly. Rows alike in
    every column share a bucket and stay rows of their own. An empty table gives no rows.
    Columns of the input named size, shard or slot are replaced.
    """
    out = docs.drop("size", "shard", "slot").withColumn("size", F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1)
    plain = [f.name for f in docs.schema.fields if f.dataType.typeName() in ("long", "integer", "string") and f.name in out.columns]
    keys = sorted(c for c in plain if c != text) + ([text] if text in plain else [])
    total = out.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    rows = out.withColumn("__bucket", F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in keys]), F.lit(buckets)))
    counts = rows.groupBy("__bucket").agg(F.count("*").alias("__n")).withColumn("__block", F.expr(f"__bucket div {BLOCK}"))
    inside = Window.partitionBy("__block").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per BLOCK buckets, so per BLOCK * bucket_bytes of text: few enough for one task.
    over = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("__block").agg(F.sum("__n").alias("__sum")).select("__block", F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__before"))
    starts = (
        counts.withColumn("__own", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
        .join(blocks, "__block")
        .select("__bucket", (F.col("__own") + F.col("__before")).alias("__start"))
    )
    columns = [F.col(c) for c in out.columns]
    # The sort makes the shuffle's input, and so its outcome, the same after a lost task.
    dealt = (
        rows.groupBy("__bucket")
        .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("__rows"))
        .join(starts, "__bucket")
        .select("__start", F.posexplode(F.shuffle("__rows", F.lit(seed))).alias("__pos", "__row"))
    )
    place = F.col("__start") + F.col("__pos")
    return dealt.select("__row.*", F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.expr(f"(__start + __pos) div {shards}").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 20240229, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write the shuffled rows, one folder per shard."""
    shard(docs, shards, seed, bucket_bytes).write.partitionBy("shard").parquet(path)
