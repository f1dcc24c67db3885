"""Dense surrogate keys and ranks (1..n) without sending all rows to one task.

A plain ``row_number`` over an unpartitioned window sorts everything in a single
task. Both functions here number the rows inside many partitions and add the number
of rows that precede each partition. The table of offsets has one row per partition
(or per source block), so it stays small however large the data is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardlake.operators.lookup import attach
from cardlake.session import stage

_POSITION = "_position"
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def _offsets(groups: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows before each group, from (group, n). One row per group, so one task is enough."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return groups.select(
        *order, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset")
    )


def dense_key(df: DataFrame, order: Sequence[Column], key: str) -> DataFrame:
    """Number rows 1..n in ``order``, which must be total (no two rows compare equal).

    Range partitioning sorts across partitions, the sort inside each partition
    finishes the order. The numbered rows are written once to the shared folder:
    the range boundaries come from a sample, so they must not be drawn twice.
    """
    ordered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    staged = stage(ordered, "dense-key")
    partition = F.shiftright(_POSITION, _ROW_BITS)
    counts = staged.groupBy(partition.alias("_partition")).agg(F.count(F.lit(1)).alias("n"))
    offsets = _offsets(counts, ["_partition"]).withColumnRenamed("_partition", "_of_partition")
    row = F.col(_POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return staged.join(
        F.broadcast(offsets), partition == F.col("_of_partition")
    ).select(
        (F.col("_offset") + row + 1).cast("bigint").alias(key),
        *df.columns,
    )


def sequence_key(
    df: DataFrame, block: Sequence[str], row: str, key: str, population: DataFrame | None = None
) -> DataFrame:
    """Number rows 1..n by (block columns, row), where a block is a piece of one source file.

    A block is what one scan task read, so no block is large and rows per block can be
    numbered by an ordinary window. Offsets come from the lineage columns alone, which
    makes them independent of how the rows are shuffled or recomputed. ``population``
    may name a cheaper table with the same lineage to count from.

    The offsets are joined on the window's own partitioning, so the rows are shuffled
    once for both, whether or not the offsets are small enough to be broadcast.
    """
    counts = (
        (population if population is not None else df)
        .groupBy(*block).agg(F.count(F.lit(1)).alias("n"))
    )
    offsets = _offsets(counts, list(block))
    numbered = df.withColumn("_row_number", F.row_number().over(
        Window.partitionBy(*block).orderBy(row)
    ))
    return (
        numbered.join(offsets, list(block))
        .withColumn(key, (F.col("_offset") + F.col("_row_number")).cast("bigint"))
        .drop("_offset", "_row_number")
    )


# So many pieces of files, about 200 bytes each, are broadcast at most.
MAX_PIECES = 500_000


def position_key(
    df: DataFrame, population: DataFrame, block: Sequence[str], row: str, file: str, place: str, key: str
) -> DataFrame | None:
    """``sequence_key`` for rows whose places in ordered files are known, without a shuffle of rows.

    A piece is what one stored file has of one block. Rows of a piece lie side by side, in
    order, so a row's number is that of the piece's first row plus its distance to it. Only
    ``population``, the narrow columns of the stored rows, is aggregated, to one row per piece.

    None where that does not hold: pieces with gaps, pieces of a block that overlap, or more
    than ``MAX_PIECES`` of them.
    """
    pieces = stage(population.groupBy(file, *block).agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("_first"), F.max(place).alias("_last"),
        F.min(row).alias("_low"), F.max(row).alias("_high")), "pieces")
    before = Window.partitionBy(*block).orderBy("_low", "_high")
    sound = pieces.select(
        (F.col("_last") - F.col("_first") + 1 == F.col("n")).alias("whole"),
        F.coalesce(F.lag("_high").over(before) < F.col("_low"), F.lit(True)).alias("apart"))
    found = sound.agg(F.count(F.lit(1)).alias("pieces"), F.min(F.col("whole") & F.col("apart")).alias("sound")).first()
    if not found["sound"] or found["pieces"] > MAX_PIECES:
        return None
    numbered = Window.orderBy(*block, "_low").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        file, *block, (F.coalesce(F.sum("n").over(numbered), F.lit(0)) - F.col("_first")).alias("_offset"))
    return df.join(F.broadcast(offsets), [file, *block]).withColumn(
        key, (F.col("_offset") + F.col(place) + 1).cast("bigint")).drop("_offset")


def competition_rank(df: DataFrame, value: str, rank: str) -> DataFrame:
    """``rank()`` over all rows by ``value`` descending; null values get no rank.

    Rows are first reduced to one per distinct value, so a value shared by very many
    rows costs nothing extra in the sort. The rank of a value is one plus the number
    of rows with a larger value.
    """
    values = (
        df.where(F.col(value).isNotNull())
        .groupBy(value).agg(F.count(F.lit(1)).alias("_weight"))
    )
    ordered = (
        values.repartitionByRange(F.col(value).desc())
        .sortWithinPartitions(F.col(value).desc())
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    staged = stage(ordered, "rank").withColumn(
        "_partition", F.shiftright(_POSITION, _ROW_BITS)
    )
    offsets = _offsets(
        staged.groupBy("_partition").agg(F.sum("_weight").alias("n")), ["_partition"]
    )
    before = (
        Window.partitionBy("_partition").orderBy(_POSITION)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        staged.withColumn("_inside", F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .join(F.broadcast(offsets), "_partition")
        .select(
            value,
            (F.col("_offset") + F.col("_inside") + 1).cast("bigint").alias(rank),
            "_weight",
        )
    )
    return attach(df, ranks, [value], [rank], weight="_weight")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Interpolated quantiles per column, exact and without sorting rows in one task.

    Works on one row per column and distinct value with its number of rows, sorted
    across partitions; a quantile needs only the values at two ranks.
    """
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").cast("double").alias("value"))
        for name in columns
    ])
    counted = (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_weight"))
    )
    order = [F.col("column_name"), F.col("value")]
    staged = stage(
        counted.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(_POSITION, F.monotonically_increasing_id()),
        "quantiles",
    ).withColumn("_partition", F.shiftright(_POSITION, _ROW_BITS))
    per_partition = staged.groupBy("column_name", "_partition").agg(F.sum("_weight").alias("n"))
    before = (
        Window.partitionBy("column_name").orderBy("_partition")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_partition.select(
        "column_name", "_partition",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"),
        F.sum("n").over(Window.partitionBy("column_name")).alias("_total"),
    )
    inside = (
        Window.partitionBy("column_name", "_partition").orderBy(_POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Rows of one value occupy the zero-based ranks from `first` up to `last`.
    ranked = (
        staged.withColumn("_upto", F.sum("_weight").over(inside))
        .join(F.broadcast(offsets), ["column_name", "_partition"])
        .withColumn("last", F.col("_offset") + F.col("_upto") - 1)
        .withColumn("first", F.col("last") - F.col("_weight") + 1)
    )
    picks, results = [], []
    for i, p in enumerate(probabilities):
        rank = (F.col("_total") - 1) * F.lit(float(p))
        for side, wanted in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            hit = (F.col("first") <= wanted) & (wanted <= F.col("last"))
            picks.append(F.max(F.when(hit, F.col("value"))).alias(f"{side}{i}"))
        picks.append(F.max(rank - F.floor(rank)).alias(f"part{i}"))
        results.append(
            (F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * F.col(f"part{i}"))
            .alias(f"p{round(p * 100)}")
        )
    return ranked.groupBy("column_name").agg(*picks).select("column_name", *results)
