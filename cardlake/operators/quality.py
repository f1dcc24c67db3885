"""Row, key and relationship controls shared by the gold, view and serving layers.

All controls of the star schema come from one pass: every table is cut into (kind of key,
key) rows, and one aggregation over both sides of each relationship tells how often a key
stands in the fact and in its dimension. Rows are combined before the shuffle, so a merchant
with a third of all transactions is one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cardlake.operators.rows import one_row

_TRANSACTION, _MERCHANT, _DATE = "t", "m", "d"


def star_controls(
    merchants: DataFrame, dates: DataFrame, fact: DataFrame,
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row of controls from one scan of each table and one shuffle.

    Rows, repeated keys and missing keys of every table (of several missing keys all but the
    first count as repeated), fact rows whose key is absent from a dimension, and the sums of
    ``totals``, columns of the fact by name.
    """
    totals = totals or {}
    keys = {_TRANSACTION: "transaction_key", _MERCHANT: "merchant_key", _DATE: "date_key"}
    values = {f"_total_{i}": column for i, column in enumerate(totals.values())}

    def entry(kind: str, key: Column, in_fact: int, in_dimension: int, carried: list[Column]) -> list[Column]:
        return [
            F.lit(kind).alias("kind"), key.cast("bigint").alias("key"), F.lit(in_fact).alias("in_fact"),
            F.lit(in_dimension).alias("in_dimension"), *carried,
        ]

    fact = fact.select(*keys.values(), *[column.alias(name) for name, column in values.items()])
    kinds = {name: fact.schema[name].dataType for name in values}
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
    carried = [F.col(name) for name in values]
    # Every fact row stands once per key; its totals travel with the date, the fewest keys.
    stacked = fact.select(F.inline(F.array(*[
        F.struct(*entry(kind, F.col(key), 1, 0, carried if kind == _DATE else nothing))
        for kind, key in keys.items()
    ])))
    for dimension, kind in ((merchants, _MERCHANT), (dates, _DATE)):
        stacked = stacked.unionByName(dimension.select(*entry(kind, F.col(keys[kind]), 0, 1, nothing)))
    per_key = stacked.groupBy("kind", "key").agg(
        F.sum("in_fact").alias("in_fact"), F.sum("in_dimension").alias("in_dimension"),
        *[F.sum(name).alias(name) for name in values],
    )

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    parts = []
    for kind, count, rows, suffix in (
        (_MERCHANT, "in_dimension", "merchant_rows", "merchant_keys"),
        (_DATE, "in_dimension", "date_rows", "date_keys"),
        (_TRANSACTION, "in_fact", "actual_fact_rows", "transaction_keys"),
    ):
        own, n = F.col("kind") == kind, F.col(count)
        parts += [
            total(own, n).alias(rows),
            total(own & (n > 0), n - 1).alias(f"duplicate_{suffix}"),
            total(own & F.col("key").isNull(), n).alias(f"missing_{suffix}"),
        ]
    unknown = F.col("key").isNull() | (F.col("in_dimension") == 0)
    parts += [
        total((F.col("kind") == kind) & unknown, F.col("in_fact")).alias(name)
        for kind, name in ((_MERCHANT, "invalid_merchant_foreign_keys"), (_DATE, "invalid_date_foreign_keys"))
    ]
    parts += [
        F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in zip(totals, values)
    ]
    return per_key.agg(*parts)


_FAULTS = ("duplicate", "missing", "invalid")


def _no_faults(row: DataFrame) -> Column:
    return sum((F.col(name) for name in row.columns if name.startswith(_FAULTS)), F.lit(0)) == 0


def gold_controls(
    merchants: DataFrame, dates: DataFrame, fact: DataFrame, expected: DataFrame | None = None,
) -> DataFrame:
    """One row with all controls of the star schema."""
    return with_verdict(star_controls(merchants, dates, fact), expected)


def with_verdict(controls: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Controls, those of ``star_controls`` or stored ones, with ``is_valid``."""
    row = controls if expected is None else one_row(controls, expected)
    valid = _no_faults(row)
    if expected is not None:
        valid = valid & (F.col("expected_fact_rows") == F.col("actual_fact_rows"))
    return row.withColumn("is_valid", valid)


def require_valid(result: dict, model: str) -> dict:
    if not result["is_valid"]:
        raise ValueError(f"{model} validation failed: {result}")
    return result


def validate_gold(
    merchants: DataFrame, dates: DataFrame, fact: DataFrame, expected: DataFrame
) -> dict:
    """Controls as a dict; an invalid model raises."""
    row = gold_controls(merchants, dates, fact, expected).first()
    return require_valid(row.asDict(), "Gold model")


def analytics_controls(merchants: DataFrame, dates: DataFrame, fact: DataFrame) -> DataFrame:
    """The star-schema controls for readers: tables must also hold rows."""
    return for_readers(star_controls(merchants, dates, fact))


def for_readers(controls: DataFrame) -> DataFrame:
    """Controls with the readers' verdict; repeated keys are rows less distinct keys, so that
    all rows with a missing key count."""
    row = controls.withColumnsRenamed({"actual_fact_rows": "transaction_rows"}).withColumns({
        f"duplicate_{suffix}": F.col(f"duplicate_{suffix}")
        + (F.col(f"missing_{suffix}") > 0).cast("bigint")
        for suffix in ("merchant_keys", "date_keys", "transaction_keys")
    })
    filled = F.least("merchant_rows", "date_rows", "transaction_rows") > 0
    return row.withColumn("is_valid", _no_faults(row) & filled)
