"""Connected components of a table of links, on Spark alone.

Alternating large-star and small-star steps: every node is tied to ever smaller ids until
each component is a star around its smallest id, after a number of rounds that grows with
the logarithm of the graph. Every round is written to the shared folder. Grouping is a
minimum with partial aggregation and a join, so that a node with very many links is
neither gathered in one task nor in one row.
"""

from pyspark.sql import DataFrame, functions as F

from pointstream.llm.frames import kept


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    tied = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest id.

    ``links`` has columns ``a`` and ``b``. A link of a node to itself is no link.
    """
    spark = links.sparkSession
    edges = links.filter("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
    edges = kept(spark, edges, "links")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        edges = kept(spark, _small_star(_large_star(edges)).distinct(), "links")
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return kept(
        spark,
        star.unionAll(star.select(F.col("component").alias("node"), "component").distinct()),
        "components",
    )
