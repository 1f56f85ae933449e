"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, folder: str) -> DataFrame:
    """``(node, label)`` of every node of ``links`` (columns ``a``, ``b``): the least node of
    its component.

    Each round takes the least label among a node's neighbours and then the label of
    that label, so chains shorten by halves; rounds are tables under ``folder``.
    """
    spark = links.sparkSession
    both = links.where("a <> b").select(F.explode(F.expr("array(struct(a, b), struct(b AS a, a AS b))")).alias("x"))
    both.select("x.a", "x.b").distinct().write.parquet(f"{folder}/links")
    edges = spark.read.parquet(f"{folder}/links")
    edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")).write.parquet(
        f"{folder}/labels-0"
    )
    step = 0
    while True:
        now = spark.read.parquet(f"{folder}/labels-{step}")
        near = edges.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        best = now.join(near.agg(F.min("label").alias("near")), "node").select(
            "node", "label", F.least("label", "near").alias("best")
        )
        up = now.select(F.col("node").alias("best"), F.col("label").alias("up"))
        step += 1
        best.join(up, "best").select(
            "node", F.least("best", "up").alias("label"), (F.least("best", "up") != F.col("label")).alias("moved")
        ).write.parquet(f"{folder}/labels-{step}")
        made = spark.read.parquet(f"{folder}/labels-{step}")
        if made.where("moved").isEmpty():
            return made.select("node", "label")
