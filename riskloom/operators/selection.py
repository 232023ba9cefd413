"""Order statistics by narrowing ranges of values, without sorting or ranking the table.

A quantile sketch per range, combined in every task, proposes cuts; one exact count per cell between the
cuts says which cell holds a wanted place; only that cell's values are looked at in the next round.  The sketch
decides how fast ranges shrink and never what the answer is.  Each cut is a cell of its own, so a value
that most rows share ends the search at once.  Rows are shuffled only when a range has at most `SORTED` rows.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import stored

CELLS = 32
# Rows of a range that one task sorts in the end.
SORTED = 50_000
RANGE = ["group", "low", "high"]


def _cuts() -> Column:
    return F.percentile_approx("value", [i / CELLS for i in range(1, CELLS)], 50 * CELLS).alias("cuts")


def _inside(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each row with the ranges of its group that hold it; ranges are few, so Spark broadcasts them if it can."""
    return rows.join(ranges, "group").where("value >= low AND value <= high")


def _narrowed(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The cells that hold the wanted places, as ranges: RANGE, `n` (rows), `wanted` (name and place in the range)."""
    below = F.size(F.filter("cuts", lambda cut: cut < F.col("value")))
    cell = 2 * below + F.array_contains("cuts", F.col("value")).cast("int")
    cells = (
        _inside(rows, ranges.select(*RANGE, "cuts"))
        .groupBy(*RANGE, cell.alias("cell"))
        .agg(
            F.sum("weight").alias("size"), F.count("*").alias("n"),
            F.min("value").alias("least"), F.max("value").alias("most"),
        )
    )
    # At most 2 * CELLS rows per range.
    earlier = Window.partitionBy(*RANGE).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    wanted = ranges.select(*RANGE, F.inline("wanted"))
    return (
        placed.join(wanted, RANGE)
        .where("place >= start AND place < start + size")
        .groupBy("group", F.col("least").alias("low"), F.col("most").alias("high"))
        .agg(
            F.max("n").alias("n"),
            F.collect_list(F.struct("name", (F.col("place") - F.col("start")).alias("place"))).alias("wanted"),
        )
    )


def values_at(
    rows: DataFrame,
    keys: list[str],
    value: Column,
    places: dict[str, Callable[[Column], Column]],
    weight: Column | None = None,
) -> DataFrame:
    """Per group, one column per name in `places`: the value at a 0-based place in ascending order.

    A place is a function of the group's size (the sum of the weights, one per row without `weight`; weights are
    positive integers); outside of the group it gives null.  Null values are ignored, groups without any other
    value do not appear, and null keys are a group.
    """
    group = F.struct(F.lit(0).alias("all"), *[F.col(key).alias(f"k{i}") for i, key in enumerate(keys)])
    thin = stored(
        rows.select(
            group.alias("group"), value.alias("value"), (F.lit(1) if weight is None else weight).cast("long").alias("weight")
        ).where("value IS NOT NULL")
    )
    size = F.col("size")
    wanted = F.array(
        *[F.struct(F.lit(name).alias("name"), at(size).cast("long").alias("place")) for name, at in places.items()]
    )
    whole = thin.groupBy("group").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("weight").alias("size"), _cuts()
    )
    groups = stored(whole.withColumn("wanted", wanted))
    ranges = stored(_narrowed(thin, groups))
    while (ranges.where("low < high").agg(F.max("n")).first()[0] or 0) > SORTED:
        cuts = _inside(thin, ranges.select(*RANGE)).groupBy(*RANGE).agg(_cuts())
        ranges = stored(_narrowed(thin, stored(ranges.join(cuts, RANGE))))
    # Equal values may stand in any order: each row covers the places of its weight.
    upto = F.sum("weight").over(
        Window.partitionBy(*RANGE).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    hit = F.filter("wanted", lambda w: (w.place < F.col("upto")) & (w.place >= F.col("upto") - F.col("weight")))
    is_open = F.col("low") < F.col("high")
    found = (
        _inside(thin, ranges.where(is_open)).withColumn("upto", upto).select("group", "value", F.inline(hit))
        .unionByName(ranges.where(~is_open).select("group", F.col("low").alias("value"), F.inline("wanted")))
        .select("group", "name", "value")
    )
    # Groups without any place inside of them stay, with nulls.
    no_place = groups.select("group", F.lit(None).cast("string").alias("name"), F.col("low").alias("value"))
    picks = [F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in places]
    every = found.unionByName(no_place).groupBy("group").agg(*picks)
    return every.select(*[F.col(f"group.k{i}").alias(key) for i, key in enumerate(keys)], *places)
