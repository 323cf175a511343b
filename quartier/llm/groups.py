"""Connected components of links that Spark holds as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartier.session import cut_lineage

#: Rows that one label's rows are dealt over when they look their label's own label up.
DEALT = 32


def components(links: DataFrame) -> DataFrame:
    """(cid, comp) of every node of ``links`` (a, b): the least node it is linked with over any number of links.

    Each round takes the least label among a node's neighbours and then that label's own label, so rounds grow with the
    logarithm of the longest chain; each is kept as a table. Labels are few where components are large: they are looked up
    from a list of distinct labels, repeated ``DEALT`` times, so that a giant component's nodes are dealt over tasks.
    """
    both = cut_lineage(links.union(links.select("b", "a")).distinct())
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp"))
    labels = cut_lineage(labels.select(F.col("a").alias("cid"), "comp"))
    dealt = F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("_part")
    while True:
        near = both.join(labels.toDF("b", "comp"), "b").groupBy("a").agg(F.min("comp").alias("least"))
        least = labels.join(near.withColumnRenamed("a", "cid"), "cid").select("cid", "comp", F.least("comp", "least").alias("least"))
        least = cut_lineage(least)
        asked = least.select("least").distinct()
        jump = least.select(F.col("cid").alias("least"), F.col("least").alias("further"))
        jump = asked.join(jump, "least").select("least", "further", dealt)
        part = F.pmod(F.xxhash64("cid"), F.lit(DEALT)).cast("int")
        new = least.withColumn("_part", part).join(jump, ["least", "_part"]).select("cid", "comp", F.least("least", "further").alias("new"))
        new = cut_lineage(new)
        labels = new.select("cid", F.col("new").alias("comp"))
        if new.where("new <> comp").isEmpty():
            return labels
