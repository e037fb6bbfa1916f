"""Rendezvous hashing of record keys over weighted shards, in DataFrame functions alone.

Every record draws one number per shard from a hash of its key and the shard's name, scaled by the
shard's weight, and goes where its number is highest. A shard that is added takes records only into
itself; a shard that is removed gives its records to the others, and nobody else moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS = 40
SLOT_GROUPS = 1024
ROW_OVERHEAD = 16


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to ``len(weights) - 1``, that wins ``key``; each wins in proportion to its weight.

    A shard's draw is ``-weight / ln(u)`` for a hash ``u`` in (0, 1); a weight of 0 wins nothing. Equal
    draws go to the lower shard. A null key is a key like any other: all null keys share one shard.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("shards need weights of at least 0, one of them above 0")
    known = F.coalesce(key.cast("string"), F.lit("\x00null"))

    def draw(weight: Column, shard: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(known, shard.cast("int")), 11)
        uniform = (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
        return F.struct((-weight / F.ln(uniform)).alias("draw"), (-shard).alias("order"))

    return -F.array_max(F.transform(F.array(*[F.lit(float(w)) for w in weights]), draw))["order"]


def shard_records(records: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """All records with their shard in ``name``, without a shuffle; a column of that name is replaced."""
    return records.withColumn(name, rendezvous(F.col(key), weights).cast("int"))


def number_slots(
    records: DataFrame, key: str, shard: str = "shard", slot: str = "slot", groups: int = SLOT_GROUPS
) -> DataFrame:
    """Places 0, 1, 2, … within each shard, in ``slot``, without bringing a shard together in one task.

    A shard is numbered in ``groups`` parts by a hash of the key; the parts' sizes, one small row each,
    give the first place of every part. Records of one key follow each other in no set order.
    """
    part = "__part"
    dealt = records.withColumn(part, F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(groups)).cast("int"))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    first = (
        dealt.groupBy(shard, part)
        .agg(F.count(F.lit(1)).alias("__size"))
        .withColumn("__first", F.coalesce(F.sum("__size").over(before), F.lit(0)))
        .select(F.col(shard).alias("__shard_of"), F.col(part).alias("__part_of"), "__first")
    )
    place = F.row_number().over(Window.partitionBy(shard, part).orderBy(key))
    return (
        dealt.withColumn("__place", place)
        .join(first, (F.col(shard) == F.col("__shard_of")) & (F.col(part) == F.col("__part_of")))
        .withColumn(slot, F.col("__first") + F.col("__place") - 1)
        .drop(part, "__place", "__shard_of", "__part_of", "__first")
    )


def op2_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 equal shards by ``doc_id``, with the shard they would have among 41.

    A null text counts as empty. Texts play no part in the placing, so equal texts may be apart.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    records = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = shard_records(records, "doc_id", [1.0] * SHARDS)
    grown = shard_records(placed, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    return number_slots(grown, "doc_id").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
