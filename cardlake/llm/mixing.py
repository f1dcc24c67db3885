"""Mixing sources to target weights by systematic sampling.

A source that should supply ``target`` of its ``source_size`` words takes each of its
documents ``target / source_size`` times in expectation. The expected copies are summed up
within the source, one random offset is added, and a document is emitted once for every
integer that its piece of the sum crosses. Documents are summed in order of size, so that
neighbours stand in for each other and the words taken stay within about one document of
the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardlake.session import stage

# Words are runs of anything but ASCII white space (fixed value).
WORD = r"[^\x20\x09-\x0D]+"


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the source and the seed alone.

    16 bits, so that sums with ranks of many billions stay exact in a double.
    """
    key = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("long") / F.lit(65536.0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_repeats: float) -> DataFrame:
    """One row per source with ``source_size`` and ``target``.

    Sources in code-point order, null last, get the weights in turn. Together they are to
    supply as many words as there are; what exceeds ``max_repeats`` times a source's size is
    shared again by weight. The sources that reach their limit are the first ones in order
    of limit per weight, so one running sum finds the final shares.
    """
    listed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (place % len(weights) + 1).cast("int"))
    listed = listed.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(max_repeats))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    listed = (
        listed.withColumn("left", F.sum("source_size").over(everything)
                          - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("weights_left", F.sum("weight").over(everything)
                    - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("weights_left"))
        .withColumn("free", F.col("limit") > F.col("level") * F.col("weight"))
    )
    # Beyond the first source below its limit the level stays as it is there.
    level = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.coalesce(F.least(F.col("limit"), level * F.col("weight")), F.col("limit"))
    return listed.select(F.col("source").alias("target_source"), "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    max_repeats: float = 3.0,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    row_column: str | None = None,
) -> DataFrame:
    """How often the mix takes each document.

    Returns ``id_column``, ``source``, ``size`` (words; null text: 0), ``source_size``,
    ``target``, ``copies`` and ``taken`` (``copies * size``), one row per input row.
    Null sources form a source of their own. A source without words has target 0 and
    copies 0. Rows with equal size are ordered by a hash of the id, then the id; equal rows
    are interchangeable. The same input and seed give the same copies. ``row_column`` may name
    a column that tells rows apart (ids can be null or repeated); it is returned first.

    Ranks come from one range shuffle of narrow rows on (source, size, hash, id): a hot
    source spreads over many partitions. The sorted rows are stored once; partition counts
    per source give the offsets of ranks.
    """
    carried = [] if row_column is None else ["row_key"]
    # Rows without an id, or with the same, are ordered by their text, not by their place.
    marked = [F.xxhash64(F.col(text_column).cast("string")).alias("mark") for _ in carried]
    rows = docs.select(
        *[F.col(row_column).alias(c) for c in carried], *marked, F.col(id_column).alias("mix_id"),
        F.col(source_column).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).withColumn("tie", F.substring(F.md5(F.coalesce(F.col("mix_id").cast("string"), F.lit(""))), 1, 8))
    ordering = [F.col("source").asc_nulls_last(), F.col("size"), F.col("tie"), F.col("mix_id"),
                *[F.col("mark") for _ in carried]]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    sorted_rows = stage(
        rows.repartitionByRange(partitions, *ordering).sortWithinPartitions(*ordering)
        .withColumn("place", place)
        .select(*carried, "mix_id", "source", "size", F.shiftright("place", 33).alias("block"),
                F.expr("place & 8589934591L").alias("place")),
        "mix",
    )
    blocks = sorted_rows.groupBy("source", "block").agg(
        F.count("*").alias("n"), F.min("place").alias("first"), F.sum("size").alias("size"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(blocks, weights, max_repeats)
    starts = (
        blocks.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
        .join(targets, F.col("source").eqNullSafe(F.col("target_source")))
        .select(F.col("source").alias("block_source"), F.col("block").alias("block_id"), "earlier",
                "source_size", "target")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sorted_rows.join(
        starts, (F.col("block") == F.col("block_id")) & F.col("source").eqNullSafe(F.col("block_source")))
    rank = F.col("place") + F.col("earlier")
    crossed = lambda end: F.floor(end * rate + offset(F.col("source"), seed))
    return joined.select(
        *[F.col(c).alias(row_column) for c in carried], F.col("mix_id").alias(id_column), "source", "size", "source_size", "target",
        (crossed(rank + 1) - crossed(rank)).alias("copies"),
    ).withColumn("taken", F.col("copies") * F.col("size"))
