"""Global ranks and running totals that never bring the whole table into one task.

`Window.orderBy` without a partition would sort everything in a single task.  Here
the rows are range-partitioned into pieces, the pieces' totals (one row per piece,
a few thousand for billions of rows) give each piece its starting value, and the
running part is local to a piece.  With a unique key no piece can be much
larger than another, whatever the distribution of the values.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import stored


# Rows that one task sorts; the number of pieces follows from it.
ROWS_PER_PIECE = 5_000_000


def in_pieces(df: DataFrame, keys: list[str], is_stored: bool = False) -> DataFrame:
    """Adds `piece`, ascending in key order, and stores the rows with it.

    Range bounds are sampled anew by every job, so totals and rows have to be read
    from one stored cut.  Sampling reads the rows a second time: unless `is_stored`
    says that they can be read cheaply, they are stored before.
    """
    rows = df if is_stored else stored(df)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-rows.count() // ROWS_PER_PIECE))
    return stored(rows.repartitionByRange(parts, *keys).withColumn("piece", F.spark_partition_id()))


def _starts(pieces: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per piece, the sum over all earlier pieces."""
    per_piece = pieces.groupBy("piece").agg(
        *[F.sum(value).alias(name) for name, value in totals.items()]
    )
    earlier = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return per_piece.select(
        "piece",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_start") for name in totals],
    )


def running_totals(
    df: DataFrame, keys: list[str], totals: dict[str, Column], is_stored: bool = False
) -> DataFrame:
    """Adds, per entry of `totals`, the sum of its value over all rows up to this one.

    `keys` must order the rows totally.
    """
    pieces = in_pieces(df, keys, is_stored)
    upto = (
        Window.partitionBy("piece")
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = pieces.join(F.broadcast(_starts(pieces, totals)), "piece")
    running = [
        (F.col(f"{name}_start") + F.sum(value).over(upto)).alias(name)
        for name, value in totals.items()
    ]
    return joined.select(*df.columns, *running)


def rows_at_ranks(
    df: DataFrame, keys: list[str], ranks: list[int], is_stored: bool = False
) -> DataFrame:
    """The rows whose 0-based position in key order is in `ranks`, with their `position`.

    Only the pieces that hold a wanted position are sorted.
    """
    pieces = in_pieces(df, keys, is_stored)
    starts = _starts(pieces, {"n": F.lit(1)})
    sizes = pieces.groupBy("piece").agg(F.count("*").alias("size"))
    wanted = F.array(*[F.lit(rank).cast("long") for rank in ranks])
    holding = (
        starts.join(sizes, "piece")
        .where(
            F.exists(
                wanted,
                lambda r: (r >= F.col("n_start")) & (r < F.col("n_start") + F.col("size")),
            )
        )
        .select("piece", "n_start")
    )
    local = F.row_number().over(Window.partitionBy("piece").orderBy(*keys))
    return (
        pieces.join(F.broadcast(holding), "piece")
        .withColumn("position", F.col("n_start") + local - 1)
        .where(F.array_contains(wanted, F.col("position")))
        .select(*df.columns, "position")
    )


_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


def chunked_running(
    df: DataFrame,
    keys: list[str],
    chunk: str,
    order: list[str],
    running: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Running sum / max / min per key, where one key may own most of the table.

    `chunk` is a column that grows with `order` (a time slot, a block of arrival
    numbers).  Rows are windowed per (key, chunk); what earlier chunks contribute
    comes from one summary row per chunk.
    """
    inside = (
        Window.partitionBy(*keys, chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    summary = df.groupBy(*keys, chunk).agg(
        *[_COMBINE[kind](value).alias(name) for name, (kind, value) in running.items()]
    )
    carried = summary.select(
        *keys,
        chunk,
        *[
            _COMBINE[kind](name).over(earlier).alias(f"{name}_carried")
            for name, (kind, _) in running.items()
        ],
    )
    local = df.withColumns(
        {name: _COMBINE[kind](value).over(inside) for name, (kind, value) in running.items()}
    )
    merged = []
    for name, (kind, _) in running.items():
        mine, before = F.col(name), F.col(f"{name}_carried")
        if kind == "sum":
            both = F.coalesce(before, F.lit(0)) + F.coalesce(mine, F.lit(0))
        else:
            both = F.greatest(mine, before) if kind == "max" else F.least(mine, before)
        merged.append(both.alias(name))
    rest = [column for column in df.columns if column not in running]
    return local.join(carried, [*keys, chunk]).select(*rest, *merged)
