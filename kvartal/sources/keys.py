"""An index of seen keys, kept batch by batch: the keys by bucket, and bitmaps that say no.

Every key sets one bit of a fixed number of bits; the bits that are set are kept as bitmaps of
32,768, one row each. A key whose bit is not set has not been seen, which settles almost all new
keys with a join to a few rows. Only keys whose bit is set are looked up among the stored keys,
in buckets that such keys fall into: buckets are folders, so the others are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: bits for all keys together: 4,096 bitmaps of 4 kB at most. Some ten million keys fill a tenth
#: of them; with more keys more are looked up, none is missed.
BITS = 2**27
BUCKETS = 32
KEYS, BITMAPS = "keys", "bitmaps"


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def _bucket(key: Column) -> Column:
    """Independent of the bit."""
    return F.pmod(F.hash(key), F.lit(BUCKETS)).cast("int")


def bitmaps_of(seen: DataFrame) -> DataFrame:
    """(number, bits): the bits of the keys in the only column."""
    bit = _bit(F.col(seen.columns[0]))
    return seen.select(
        F.bitmap_bucket_number(bit).alias("number"), F.bitmap_bit_position(bit).alias("position")
    ).groupBy("number").agg(F.bitmap_construct_agg("position").alias("bits"))


def marked(rows: DataFrame, key: str, known: DataFrame, how: str = "left") -> DataFrame:
    """The rows with a flag ``_maybe`` whether their key's bit is set. An inner join leaves out rows whose
    bitmap is not there."""
    bit = _bit(F.col(key))
    byte = F.substring("_bits", (F.col("_position") / 8).cast("int") + 1, F.lit(1))
    is_set = F.conv(F.hex(byte), 16, 10).cast("bigint").bitwiseAND(
        F.expr("shiftleft(1L, cast(_position % 8 AS int))")
    ) != 0
    return (
        rows.withColumn("_number", F.bitmap_bucket_number(bit))
        .withColumn("_position", F.bitmap_bit_position(bit))
        .join(known.select(F.col("number").alias("_number"), F.col("bits").alias("_bits")), "_number", how)
        .withColumn("_maybe", F.coalesce(is_set, F.lit(False)))
        .drop("_number", "_position", "_bits")
    )


def maybe(rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """The rows whose key may be one of those that the bitmaps were made of."""
    return marked(rows, key, known, "inner").filter("_maybe").drop("_maybe")


def write(seen: DataFrame, folder: str) -> None:
    """Index a column of distinct keys in a folder."""
    key = F.col(seen.columns[0])
    seen.select(key.alias("key"), _bucket(key).alias("bucket")).repartition(
        "bucket"
    ).write.partitionBy("bucket").parquet(f"{folder.rstrip('/')}/{KEYS}")
    bitmaps_of(seen).write.parquet(f"{folder.rstrip('/')}/{BITMAPS}")


def _read(spark: SparkSession, folders: Sequence[str], table: str, schema: str) -> DataFrame:
    frames = [
        spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{table}") for folder in folders
    ]
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame)
    return found


def stored(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """Keys of all folders; one in several of them stands several times."""
    return _read(spark, folders, KEYS, "key string, bucket int")


def bitmaps(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    found = _read(spark, folders, BITMAPS, "number bigint, bits binary")
    return found.groupBy("number").agg(F.bitmap_or_agg("bits").alias("bits"))


def merge(spark: SparkSession, folders: Sequence[str], into: str) -> None:
    """One index of several."""
    stored(spark, folders).distinct().repartition("bucket").write.partitionBy("bucket").parquet(
        f"{into.rstrip('/')}/{KEYS}"
    )
    bitmaps(spark, folders).write.parquet(f"{into.rstrip('/')}/{BITMAPS}")


def without_stored(rows: DataFrame, key: str, folders: Sequence[str]) -> DataFrame:
    """The rows whose key is in no index of the folders. Rows without a key stay."""
    spark = rows.sparkSession
    # at most BITS / 32,768 rows of 4 kB
    told = marked(rows, key, F.broadcast(bitmaps(spark, folders)))
    asked = told.filter("_maybe").select(F.col(key).alias("key")).distinct().withColumn(
        "bucket", _bucket(F.col("key"))
    )
    # the asked keys decide which buckets are read, and which of their keys go on
    found = stored(spark, folders).join(asked, ["bucket", "key"], "left_semi").select(
        F.col("key").alias("_found")
    )
    return told.join(found, F.col("_maybe") & (F.col(key) == F.col("_found")), "left_anti").drop("_maybe")
