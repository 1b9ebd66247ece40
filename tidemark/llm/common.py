"""Helpers the operators share: tables, written intermediates, links and numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.session import scratch_path

# Rows numbered by one window group.
NUMBERING_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a new table in the shared folder: lineage ends here and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fields_and(df: DataFrame, ddl: str) -> StructType:
    """The fields of ``df`` and those of a DDL text, as a schema."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable vertex of each vertex of the links ``(a, b)``: columns ``v``, ``label``.

    Every round takes the smallest label of the neighbours and then jumps to the
    label's own label, so chains shorten geometrically. Each round is written to
    the shared folder. A hot vertex is combined before the shuffle and its join
    is one that AQE can split.
    """
    both = written(
        edges.where(F.col("a") != F.col("b"))
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b")
        .distinct(),
        "links",
    )
    labels = written(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("v", "b"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("label").alias("near"))
        )
        pulled = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("far"))
        moved = written(
            pulled.join(jump, "label", "left").select("v", "old", F.coalesce("far", "label").alias("label")), "labels"
        )
        labels = moved.select("v", "label")
        if moved.where(F.col("label") != F.col("old")).limit(1).count() == 0:
            return labels


def numbered(
    df: DataFrame, group: Sequence[str], order: Sequence[str], rows: int, name: str, together: Sequence[str] = ()
) -> DataFrame:
    """Add ``name``: gapless position from 0 inside each group, over ``rows`` rows in all.

    Rows fall by a hash of the order columns into logical buckets of bounded size;
    a row's number is its place in its bucket plus the rows of earlier buckets.
    No group is ever sorted in one task. Rows equal in the first order columns,
    if named by ``together``, get neighbouring numbers; the caller bounds them.
    """
    buckets = max(1, -(-rows // NUMBERING_ROWS))
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(*(together or order)), F.lit(buckets)))
    keys = [*group, "_bucket"]
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    joined = placed.withColumn("_place", place).join(offsets, keys)
    return joined.withColumn(name, F.col("_before") + F.col("_place")).drop("_bucket", "_before", "_place")
