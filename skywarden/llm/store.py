"""Intermediate tables in the folder that all executors share, and connected components over stored links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.session import work_dir

# Numbers that a filter of hashes tells apart; its bitmap has 8 MB, whatever the number of hashes.
FILTER_BITS = 26


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write the rows below ``spark.checkpoint.dir`` and read them back: lineage ends here, and nothing runs twice.
    ``options`` are those of the writer."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column is called so."""
    while name in df.columns:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spot(hash_: Column) -> Column:
    return F.pmod(hash_, F.lit(1 << FILTER_BITS)) + 1


def hash_filter(hashes: DataFrame) -> DataFrame:
    """``part, bits``: a stored bitmap of the numbers that the hashes (the one column, long, not null) fall on."""
    spot = _spot(F.col(hashes.columns[0]))
    dealt = hashes.select(F.bitmap_bucket_number(spot).alias("part"), F.bitmap_bit_position(spot).alias("at"))
    # Dealt first, so that bits travel, not the bitmaps of every task.
    return stored(dealt.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits")), "filter")


def possible(rows: DataFrame, hash_: str, known: DataFrame, flag: str) -> DataFrame:
    """``rows`` with the boolean column ``flag``: false where the long column ``hash_`` is certainly none of those in
    ``known`` (a ``hash_filter``), so that such rows need not be moved to a join with them. Others may be true as well."""
    part, bits = free_name(rows, "_part"), free_name(rows, "_bits")
    at = F.bitmap_bit_position(_spot(F.col(hash_)))
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.withColumn(part, F.bitmap_bucket_number(_spot(F.col(hash_)))).join(
        F.broadcast(known.select(F.col("part").alias(part), F.col("bits").alias(bits))), part, "left").withColumn(
        flag, F.coalesce(F.bit_get(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop(part, bits)


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of ``links`` (a, b), as ``node, label``; nodes without links are left out.

    Alternating large-star and small-star steps. A step aggregates to one minimum per node and joins it back, so a node
    with very many links is combined on the map side and its join can be split. Only the number of links that a step
    moved reaches the driver.
    """
    edges = stored(links.where(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
            .where("u != v").distinct())
        small = stored(small, "small-star")
        moved = small.join(edges, ["u", "v"], "left_anti").limit(1).count() + edges.join(
            small, ["u", "v"], "left_anti").limit(1).count()
        edges = small
        if not moved:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
