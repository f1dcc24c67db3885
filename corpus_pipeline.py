"""A training corpus from raw documents, as stages that are each written and read again.

Every stage takes what the one before it kept. The first four return the columns of
``documents``; the last returns the mix. Stages store nothing but their result.
"""

from __future__ import annotations

import functools
import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake.llm import decontaminate, language_id, mixing, ngram_join, pii
from cardlake.llm.queries import MIX_WEIGHTS, QUERY_KEY, table
from cardlake.session import stage

# Near duplicates: five-word shingles, Jaccard similarity of 80 % or more.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses for its own columns, and the name of each."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def _back(apart: DataFrame, own: dict[str, str], changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns under their given names, some of them changed."""
    return apart.select(*[(changed or {}).get(c, F.col(name)).alias(c) for c, name in own.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised, and gives them that language.

    Learned from the labelled documents of the stage's own input. Rejected are texts that are
    null or have no letter, and texts far from every language. Other columns stay as they are.
    """
    apart, own = _apart(docs)
    found = language_id.identify(apart, language_id.fit(docs), own["text"]).where(~F.col("lang_rejected"))
    return _back(found, own, {"lang": F.col("lang_nearest")})


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every class of near duplicates.

    Documents without words are classes of their own. Of rows that repeat an id one stays,
    the first in order of text (null last) and then of a hash of the other columns; rows with
    a null id all stay.
    """
    docs = _one_per_id(docs)
    classes = ngram_join.jaccard_components(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    dropped = classes.where("doc_id <> component_id").select(F.col("doc_id").alias("dropped")).distinct()
    apart, own = _apart(docs)
    return _back(apart.join(dropped, F.col(own["doc_id"]) == F.col("dropped"), "left_anti"), own)


def _one_per_id(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each id; only rows of repeated ids are shuffled whole."""
    apart, own = _apart(docs)
    doc_id, text = own["doc_id"], own["text"]
    repeated = stage(apart.where(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.count("*").alias("n")).where("n > 1").select(
        F.col(doc_id).alias("repeated")), "repeated")
    if repeated.isEmpty():
        return docs
    same = F.col(doc_id) == F.col("repeated")
    several = apart.join(repeated, same, "left_semi").groupBy(F.col(doc_id).alias("id")).agg(
        F.min_by(F.struct(*apart.columns), F.struct(F.col(text).isNull(), F.col(text), F.xxhash64(*apart.columns))).alias("row"))
    return stage(_back(apart.join(repeated, same, "left_anti").union(several.select("row.*")), own), "one_per_id")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no benchmark item was found."""
    apart, own = _apart(docs)
    found = decontaminate.find_leaks(apart, table(spark, sf_dir, "benchmark"), text_column=own["text"])
    return _back(found.where(F.size("leaks") == 0), own)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms and keeps every document."""
    apart, own = _apart(docs)
    text = F.col(own["text"])
    length = {"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in own else {}
    return _back(pii.pseudonymise(apart, QUERY_KEY, own["text"]), own, length)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once per copy taken (``copy`` counts from 1).

    Every row meets its own copies: rows are told apart by their place, so ids may be null
    or repeated. Places are stored with the rows, as another scan may deal rows anew.
    """
    apart, own = _apart(docs)
    placed = stage(apart.withColumn("row_key", F.monotonically_increasing_id()), "placed")
    asked = placed.select("row_key", *[F.col(own[c]).alias(c) for c in ("doc_id", "text", "source")])
    taken = mixing.mix(asked, MIX_WEIGHTS, row_column="row_key").where("copies > 0").select(
        F.col("row_key").alias("mix_key"), F.col("copies").cast("int").alias("copies"))
    return placed.join(taken, F.col("row_key") == F.col("mix_key")).select(
        *[F.col(name).alias(c) for c, name in own.items()],
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _after_cleaning(step: Stage) -> Stage:
    """The stage, begun by letting go of what earlier ones left behind.

    Spark drops broadcasts and shuffles, on the driver and on executors, once the driver's
    garbage collection finds nobody who refers to them. A driver collects late; stages that
    follow each other need the memory now.
    """
    @functools.wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        return step(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _after_cleaning(step)) for name, step in (
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("pseudonyms", pseudonymise),
    ("mix", mix_sources),
)]

# Learned models, hashes and keyed permutations are not SQL; a brute-force test stands in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
