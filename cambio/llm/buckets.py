"""Buckets of items that share a key: stars, and cells of bounded size for what a star leaves apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members of each side of a cell.
CELL_MEMBERS = 512


def cells(members: DataFrame) -> DataFrame:
    """(key, p, q, id, component, first, again) rows: the members of buckets with several components, dealt into cells.

    Of each such bucket, the component with most members is one side and all others are the other; both sides are cut
    into blocks of about CELL_MEMBERS by a hash of the id. A cell holds two blocks, and every two members of different
    components meet in a cell. The large side is only copied as often as the small one has blocks.
    """
    by_component = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    apart = (
        by_component.groupBy("key")
        .agg(
            F.max_by("component", F.struct("n", "component")).alias("main_component"),
            F.max("n").alias("main_members"),
            F.sum("n").alias("members"),
            F.count(F.lit(1)).alias("components"),
        )
        .where("components > 1")
    )

    def blocks(count: Column) -> Column:
        return F.ceil(count / F.lit(CELL_MEMBERS)).cast("int")

    rows = members.join(apart, "key").select(
        "key",
        "id",
        "component",
        (F.col("component") == F.col("main_component")).alias("main"),
        blocks(F.col("main_members")).alias("mains"),
        blocks(F.col("members") - F.col("main_members")).alias("others"),
    )
    number = F.when(F.col("main"), F.col("mains")).otherwise(F.col("others"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "key"), number).cast("int"))
    meets = F.expr(
        """
        CASE WHEN main THEN transform(sequence(0, others - 1), r -> struct(r AS p, others + block AS q))
        ELSE concat(
            transform(sequence(0, mains - 1), s -> struct(block AS p, others + s AS q)),
            transform(filter(sequence(0, others - 1), r -> r <> block),
                      r -> struct(least(r, block) AS p, greatest(r, block) AS q)))
        END
        """
    )
    dealt = rows.withColumn("cell", F.explode(meets))
    own = F.when(F.col("main"), F.col("others") + F.col("block")).otherwise(F.col("block"))
    # two members of one block meet in each cell of that block: only the cell with the first block of the large side need
    # compare them, the others compare members of the first block with members of the second
    return dealt.select(
        "key",
        "cell.p",
        "cell.q",
        "id",
        "component",
        (own == F.col("cell.p")).alias("first"),
        (F.col("cell.q") != F.col("others")).alias("again"),
    )


def cells_within(members: DataFrame) -> DataFrame:
    """(component, p, q, id) rows: the members of each component with several, in cells of two blocks (p = q: of one).

    Every two members of a component meet in exactly one cell.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL_MEMBERS)).cast("int").alias("blocks"))
    rows = members.join(sizes, "component").withColumn(
        "block", F.pmod(F.xxhash64("id", "component"), F.col("blocks")).cast("int")
    )
    meets = F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, block) AS p, greatest(x, block) AS q))")
    dealt = rows.withColumn("cell", F.explode(meets))
    return dealt.select("component", "cell.p", "cell.q", "id", (F.col("block") == F.col("cell.p")).alias("first"))
