"""Connected components in a number of rounds that grows with the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node of a link the smallest node that is reachable over links.

    Links always point from the larger to the smaller node. A round first sends each link's lower end to the lower
    end's own smallest neighbour, which halves chains, then gathers each node's lower neighbours under the smallest of
    them. Both steps keep the components; a node that many links end in costs one row a link, and its smallest
    neighbour is pre-aggregated, so no task holds the links of a node. Each round is written to the shared folder; the
    rounds end when every node has one link, to a node without one. Links with a null end or two equal ends join
    nothing. Nodes without links are not returned.
    """
    ends = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    found = cut(ends.filter("hi > lo").distinct())
    while True:
        lowest = found.groupBy("hi").agg(F.min("lo").alias("_m"), F.count("*").alias("_n"))
        if lowest.filter("_n > 1").isEmpty() and found.join(lowest.select(F.col("hi").alias("lo")), "lo", "left_semi").isEmpty():
            return found.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(found.select("lo", "lo").distinct())
        jumped = found.join(lowest.select(F.col("hi").alias("lo"), "_m"), "lo", "left").select("hi", F.coalesce("_m", "lo").alias("lo")).distinct()
        under = jumped.join(jumped.groupBy("hi").agg(F.min("lo").alias("_m")), "hi")
        gathered = under.select(F.explode(F.array(
            F.struct("hi", F.col("_m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("_m").alias("lo")),
        )).alias("_l")).select("_l.*")
        found = cut(gathered.filter("hi > lo").distinct())
