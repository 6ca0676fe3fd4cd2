"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").where("b <> m")
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return (joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b")
            .union(joined.select(F.col("m").alias("a"), "b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for each id in links (a, b) of another component than its own id.

    The component is its smallest id.  Rounds go on until no edge changes; each is stored.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges, before = stored(pairs, "edges"), None
    while True:
        sign = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003), F.sum(F.xxhash64("b", "a") % 999983)).first()
        if sign == before or sign[0] == 0:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
        before = sign
        edges = stored(_small_star(_large_star(edges)), "edges")


def no_links(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "a long, b long")
