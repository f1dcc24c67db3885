"""Many-to-one lookups that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# At most this many lookup rows are ever broadcast.
BROADCAST_ROWS = 100_000


def attach(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    weight: str,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Left join ``lookup`` to ``facts`` on null-safe ``keys`` and add its ``values``.

    ``lookup`` holds one row per key and, in ``weight``, the number of fact rows with
    that key. That number bounds what is broadcast:

    * A lookup of at most ``broadcast_rows`` rows (default ``BROADCAST_ROWS``) is
      broadcast as a whole.
    * Otherwise only keys that own more than ``1 / broadcast_rows`` of all fact rows
      are; there can be no more than ``broadcast_rows`` of them. Their rows get their
      values from the broadcast, and then travel through the second, shuffled join
      under a salt that spreads them evenly and matches nothing. No remaining key is
      large enough to overload a task.
    """
    if broadcast_rows is None:
        broadcast_rows = BROADCAST_ROWS
    size = lookup.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(weight), F.lit(0)).alias("weight")
    ).first()
    if size["rows"] <= broadcast_rows:
        return _null_safe_left(
            facts, F.broadcast(lookup.select(*keys, *values)), keys, values
        )

    hot = lookup.where(F.col(weight) * broadcast_rows > size["weight"])
    marked = lookup.select(
        *keys, *values, (F.col(weight) * broadcast_rows > size["weight"]).alias("_hot")
    )
    hot_values = [F.col(name).alias(f"_hot_{name}") for name in values]
    resolved = _null_safe_left(
        facts,
        F.broadcast(hot.select(*keys, *hot_values, F.lit(True).alias("_is_hot"))),
        keys,
        [*(f"_hot_{name}" for name in values), "_is_hot"],
    )
    spread = F.pmod(F.xxhash64(*facts.columns, F.spark_partition_id()), F.lit(1 << 20)) + 1
    salted = resolved.withColumn(
        "_salt", F.when(F.col("_is_hot"), spread).otherwise(F.lit(0)).cast("bigint")
    )
    cold = marked.where(~F.col("_hot")).select(
        *keys, *values, F.lit(0).cast("bigint").alias("_salt")
    )
    joined = _null_safe_left(salted, cold, [*keys, "_salt"], values)
    return joined.select(
        *facts.columns,
        *[F.coalesce(F.col(f"_hot_{name}"), F.col(name)).alias(name) for name in values],
    )


def _null_safe_left(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Left equi-join in which null keys equal each other; planned as a hash or merge join."""
    renamed = right.select(
        *[F.col(name).alias(f"_lookup_{name}") for name in keys], *values
    )
    condition = reduce(
        lambda a, b: a & b,
        [F.col(name).eqNullSafe(F.col(f"_lookup_{name}")) for name in keys],
    )
    return left.join(renamed, condition, "left").drop(*[f"_lookup_{name}" for name in keys])
