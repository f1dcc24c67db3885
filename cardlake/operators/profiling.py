"""Table profiles: shape, missing values, distinct values, frequencies, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cardlake import contracts
from cardlake.functions import columns as C
from cardlake.operators import keys


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type, with the number of rows."""
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    layout = F.array(*[
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
        )
        for position, field in enumerate(df.schema, 1)
    ])
    return rows.select("rows", F.inline(layout))


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and percentage per column, worst first, from one aggregation."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count(F.when(_quoted(name).isNull(), True)).alias(f"c{i}")
            for i, name in enumerate(df.columns)
        ],
    )
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("missing_count"))
        for i, name in enumerate(df.columns)
    ])
    percent = C.quotient2(100 * F.col("missing_count"), F.col("rows"))
    return (
        counts.select("rows", F.inline(pairs))
        .select(
            "column_name", "missing_count",
            percent.cast("double").alias("missing_percentage"),
        )
        .orderBy(F.desc("missing_percentage"), "column_name")
    )


def frequencies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, value, n) for every value of the columns, nulls included.

    All columns go through one shuffle as name-value pairs; equal pairs are combined
    before it, so a value that fills a third of the rows is one pair per task.
    """
    pairs = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), _quoted(name).cast("string").alias("value")
        )
        for name in columns or df.columns
    ])
    return (
        df.select(F.inline(pairs)).groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def distinct_values(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Number of different non-null values per column, exact or by sketch."""
    names = list(columns or df.columns)
    if approximate:
        sketch = df.agg(*[
            F.approx_count_distinct(_quoted(name)).alias(f"c{i}") for i, name in enumerate(names)
        ])
        pairs = F.array(*[
            F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}").alias("distinct_count"))
            for i, name in enumerate(names)
        ])
        return sketch.select(F.inline(pairs))
    return (
        frequencies(df, names).groupBy("column_name")
        .agg(F.count("value").alias("distinct_count"))
        .orderBy("column_name")
    )


def value_counts(df: DataFrame, columns: Sequence[str], top: int = 20) -> DataFrame:
    """Most frequent values of each column, nulls included.

    Spark keeps only the best ``top`` values of each task and column before the final
    ranking, so columns with very many values are not collected in one task.
    """
    best = Window.partitionBy("column_name").orderBy(
        F.desc("n"), F.col("value").asc_nulls_last()
    )
    return (
        frequencies(df, columns)
        .withColumn("position", F.row_number().over(best))
        .where(F.col("position") <= top)
        .select("column_name", "value", F.col("n").alias("value_count"), "position")
        .orderBy("column_name", "position")
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: exact repeats beyond the first occurrence."""
    names = [f"`{name}`" for name in columns or df.columns]
    groups = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")
    )


_HALF = 1_000_000_000


def _exact_sums(df: DataFrame, name: str) -> list[Column]:
    """Sums over the halves of a column's values, exact whatever the order of rows.

    A value, in millionths where its type has decimals, is ``high * 10**9 + low``. Sums of
    the halves and of their products give the sum of squares without rounding.
    """
    whole = isinstance(df.schema[name].dataType, T.IntegralType)
    scaled = F.col(f"`{name}`").cast("decimal(38,6)") * (1 if whole else 1_000_000)
    value = F.round(scaled, 0).try_cast("decimal(22,0)")
    low = (value % _HALF).cast("decimal(9,0)")
    high = ((value - low) / _HALF).cast("decimal(13,0)")
    return [
        F.sum(high).cast("decimal(25,0)").alias("high"), F.sum(low).cast("decimal(25,0)").alias("low"),
        F.try_sum(high * high).alias("high_high"), F.try_sum(high * low).alias("high_low"),
        F.try_sum(low * low).alias("low_low"), F.count(value).alias("summed"),
        F.lit(1.0 if whole else 1e6).alias("unit"),
    ]


def _deviation(sums: Column, count: Column) -> Column:
    """Sample standard deviation from exact sums, each step rounded once.

    ``n`` times the sum of squares less the square of the sum splits into the same three
    parts as the values; each part is a whole number of 38 digits at most, or null.
    """
    n = count.cast("decimal(12,0)")

    def part(products: Column, a: Column, b: Column) -> Column:
        return F.try_subtract(F.try_multiply(n, products), F.try_multiply(a, b)).cast("double")

    high, low = sums["high"].cast("decimal(19,0)"), sums["low"].cast("decimal(19,0)")
    parts = (
        part(sums["high_high"], high, high) * float(_HALF) * float(_HALF)
        + part(sums["high_low"], high, low) * 2.0 * float(_HALF)
        + part(sums["low_low"], low, low)
    )
    pairs = (n * (n - 1)).cast("double")
    return F.when((count > 1) & (sums["summed"] == count), F.sqrt(parts / pairs) / sums["unit"])


def numeric_summary(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles and maximum per column.

    Means and deviations come from exact sums, so they do not depend on the order of rows
    (values with decimals count with six of them). Where sums outgrow 38 digits, deviations
    are those of double arithmetic. Quartiles are interpolated between neighbouring ranks.
    """
    exact = "decimal(38,6)"
    moments = df.agg(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(_quoted(name)).alias("count"),
            F.try_divide(
                F.sum(_quoted(name).cast(exact)).cast("double"), F.count(_quoted(name))
            ).alias("mean"),
            F.struct(*_exact_sums(df, name)).alias("sums"),
            F.stddev_samp(_quoted(name).cast("double")).alias("rounded_std"),
            F.min(_quoted(name)).cast("double").alias("min"),
            F.max(_quoted(name)).cast("double").alias("max"),
        ).alias(f"c{i}")
        for i, name in enumerate(columns)
    ])
    rows = moments.select(
        F.inline(F.array(*[F.col(f"c{i}") for i in range(len(columns))]))
    ).withColumn("std", F.coalesce(_deviation(F.col("sums"), F.col("count")), "rounded_std"))
    quantiles = keys.exact_quantiles(df, columns, probabilities)
    labels = [f"p{round(p * 100)}" for p in probabilities]
    return rows.join(quantiles, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *labels, "max"
    ).orderBy("column_name")


def overview(df: DataFrame) -> DataFrame:
    """Per column: values present, different values, the most frequent one and its count."""
    return frequencies(df).groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
        .alias("count"),
        F.count("value").alias("unique"),
        F.max(F.when(
            F.col("value").isNotNull(), F.struct("n", "value")
        )).alias("_top"),
    ).select(
        "column_name", "count", "unique",
        F.col("_top.value").alias("top"), F.col("_top.n").alias("freq"),
    )


def summary(df: DataFrame) -> DataFrame:
    """Overview of all columns, with the numeric summary where the column is a number."""
    numeric = [
        field.name for field in df.schema if isinstance(field.dataType, T.NumericType)
    ]
    if not numeric:
        return overview(df)
    return overview(df).join(
        numeric_summary(df, numeric).drop("count"), "column_name", "left"
    )


def contract_report(columns: Sequence[str], types: dict[str, str], domain: str) -> dict:
    """Column and type differences of a source against its contract."""
    _, contract = contracts.contract_for(domain)
    return {
        "columns": contracts.check_columns(columns, contract.fieldNames()),
        "types": contracts.check_types(types, contracts.expected_types(contract)),
    }
