"""Landing files: discovery, CSV scan and per-file value checks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cardlake import contracts
from cardlake.functions import columns as C
from cardlake.sources import files, tables

_CSV_NAMES = "*.[cC][sS][vV]"
_CORRUPT = "_corrupt_record"
# A quoted field, with what follows its last quote, or a plain one.
_FIELD = r',("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'
# What a cast to bigint may take; a try_cast of any other text costs an exception inside.
_DIGITS = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def discover(spark: SparkSession, landing_path: str) -> files.Files:
    """CSV files directly in the landing directory.

    A missing directory, a file in its place and a directory without CSV files are errors.
    """
    if not tables.exists(spark, landing_path):
        raise FileNotFoundError(f"The landing directory does not exist: {landing_path}")
    if not tables.is_directory(spark, landing_path):
        raise NotADirectoryError(f"The landing path is not a directory: {landing_path}")
    jvm_path, file_system = tables.hadoop_path(spark, landing_path)
    directory = file_system.makeQualified(jvm_path).toString().rstrip("/")
    # A pattern, not the directory: sub-directories are neither listed nor read.
    pattern = f"{glob_literal(directory)}/{_CSV_NAMES}"
    if not file_system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(pattern)):
        raise FileNotFoundError(f"No CSV files were found in {landing_path}")
    return files.Files(spark, pattern, _CSV_NAMES, directory=directory)


def unscanned_files(spark: SparkSession, found: files.Files) -> list[tuple[str, str, int, str]]:
    """Path, name, size and reason of CSV files that Spark's scans leave out.

    Those are names that start with an underscore or a dot, and files without a byte.
    """
    if found.directory is None:
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{glob_literal(found.directory)}/{_CSV_NAMES}")
    out = []
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        name = status.getPath().getName()
        hidden = name.startswith(("_", "."))
        if status.isFile() and (hidden or not status.getLen()):
            reason = (
                "ValueError: Names that start with an underscore or a dot cannot be scanned"
                if hidden else "ValueError: Column validation failed: the file is empty"
            )
            out.append((status.getPath().toString(), name, status.getLen(), reason))
    return out


def single_file(spark: SparkSession, source_file: str) -> files.Files:
    """The one file given, after checking that it is an existing CSV file."""
    if not tables.exists(spark, source_file):
        raise FileNotFoundError(f"The source CSV file does not exist: {source_file}")
    if tables.is_directory(spark, source_file):
        raise ValueError(f"The source path is not a file: {source_file}")
    if not source_file.lower().endswith(".csv"):
        raise ValueError(f"Only CSV files can be ingested: {source_file}")
    return files.Files(spark, glob_literal(source_file), _CSV_NAMES)


def glob_literal(path: str) -> str:
    """The path with characters that would be read as a pattern escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def header_columns(header: Column) -> Column:
    """Column names of a header line as an array: fields between commas, quotes undone."""
    text = F.regexp_replace(F.coalesce(header, F.lit("")), "^\ufeff", "")
    # Every field is found with the comma before it, so that empty ones are found too.
    fields = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(_FIELD), F.lit(1))
    return F.transform(fields, lambda field: F.when(
        F.startswith(field, F.lit('"')),
        F.replace(F.regexp_replace(field, '^"|"$', ""), F.lit('""'), F.lit('"')),
    ).otherwise(field))


def layouts(header: Column, contract: T.StructType) -> Column:
    """Column order of a header line as JSON, or what is wrong with it.

    Headers are parsed where their files were read: the driver sees one value per layout,
    however many files there are and however long their first lines.
    """
    names = header_columns(header)
    expected = F.array(*[F.lit(name) for name in contract.fieldNames()])
    missing = F.array_sort(F.array_except(expected, names))
    unexpected = F.array_sort(F.array_except(names, expected))
    valid = (F.size(missing) == 0) & (F.size(unexpected) == 0) & (F.size(names) == len(contract))
    problem = F.substring(F.concat(
        F.lit("ValueError: Column validation failed: "),
        F.to_json(F.struct(
            F.lit(len(contract)).alias("expected_count"), F.size(names).alias("actual_count"),
            missing.alias("missing_columns"), unexpected.alias("unexpected_columns"),
        )),
    ), 1, 4000)
    return F.struct(
        F.when(valid, F.to_json(names)).alias("layout"), F.when(~valid, problem).alias("error"))


def scan(
    spark: SparkSession, paths: Sequence[str], layout: Sequence[str], multiline: bool = False
) -> DataFrame:
    """All fields as text, with the file, block and row each record came from.

    ``layout`` is the column order of these files. Records with too many or too few fields
    keep their text in one column more. Words that stand for "no value" become null.
    ``multiline`` allows line breaks inside quotes, at the price of unsplittable files.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*layout, _CORRUPT)])
    raw = (
        spark.read.schema(schema)
        .option("header", True).option("escape", '"').option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", False)
        .csv([glob_literal(path) for path in paths])
    )
    return raw.select(
        *[C.null_words_to_null(F.col(f"`{name}`")).alias(name) for name in layout],
        F.col(_CORRUPT),
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row"),
    )


def value_profile(scanned: DataFrame, contract: T.StructType) -> DataFrame:
    """Per file: rows, broken records, and value counts per column.

    Broken are records with more fields than columns, empty ones included, and records with
    a quote that is not closed. Counts are combined before the shuffle, so the size of a
    file does not matter.
    """
    # What is left of a record without its quoted parts has one comma between two fields.
    bare = F.regexp_replace(_CORRUPT, r'"[^"]*+(?:""[^"]*+)*+"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    parts = [
        F.count(F.lit(1)).alias("rows"),
        C.count_where(fields > len(contract)).alias("overlong"),
        C.count_where(F.contains(bare, F.lit('"'))).alias("unclosed"),
    ]
    for i, field in enumerate(contract):
        column = F.col(f"`{field.name}`")
        parts += [
            F.count(column).alias(f"present_{i}"),
            C.count_where(F.when(column.rlike(_DIGITS), column).try_cast("bigint").isNotNull()).alias(f"integers_{i}"),
            C.count_where(column.rlike(_NUMBER)).alias(f"numbers_{i}"),
        ]
    return scanned.groupBy("_file").agg(*parts)


def observed_types(profile: dict, contract: T.StructType) -> dict[str, str]:
    """The type each column of a file would be given from its values alone.

    Whole numbers without gaps are int64, other numbers and empty columns float64,
    everything else is text.
    """
    observed = {}
    for i, field in enumerate(contract):
        present = profile[f"present_{i}"]
        if not profile["rows"]:
            observed[field.name] = "object"
        elif present == profile["rows"] == profile[f"integers_{i}"]:
            observed[field.name] = "int64"
        elif present == profile[f"numbers_{i}"]:
            observed[field.name] = "float64"
        else:
            observed[field.name] = "str"
    return observed


def acceptable_types(profile: dict, contract: T.StructType) -> dict[str, str]:
    """Observed types, with a column counted as its contract type when every value fits it.

    Values decide and gaps are allowed: a text column that happens to hold numbers, a
    number column with missing values and an empty column all fit. A file without records
    shows no types and fits nothing.
    """
    accepted = observed_types(profile, contract)
    if not profile["rows"]:
        return accepted
    for i, (name, wanted) in enumerate(contracts.expected_types(contract).items()):
        fits = {
            "int64": profile[f"present_{i}"] == profile[f"integers_{i}"],
            "float64": profile[f"present_{i}"] == profile[f"numbers_{i}"],
            "str": True,
        }
        if fits[wanted]:
            accepted[name] = wanted
    return accepted


def typed(scanned: DataFrame, contract: T.StructType) -> list:
    """Contract columns cast from checked text."""
    return [
        F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)
        for field in contract
    ]
