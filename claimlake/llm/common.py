"""What several operators share: reading tables, tables staged in the shared folder, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(docs: DataFrame, name: str = "given"):
    """A row of ``docs`` as one struct column, whatever its columns are called."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias(name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: later stages and lost executors
    start from the files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: the smallest node reachable.

    Alternating large-star and small-star rounds: each hangs neighbours below the smallest node seen, by
    aggregation and joins over edges only, until nothing changes.  Work tables are staged each round.
    Raises if ``max_rounds`` (logarithmic in the longest path) do not suffice.
    """
    e = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               "cc")
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        e = staged(small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                  F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                   .select("e.a", "e.b").filter("a <> b").distinct(), "cc")
        now = e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.countDistinct("a")).first()
        if now == state or now[0] == now[2] and not e.join(e.select(F.col("a").alias("b")), "b", "left_semi").count():
            break
        state = now
    else:
        raise RuntimeError("connected components did not settle")
    pairs = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
