"""URL filtering against dated lists: validity intervals and an as-of join.

A list is a log of dated changes (``add`` or ``remove`` of a host or of a host with a path
prefix). Successive changes of an entry become validity intervals, and every capture is
judged by the entries that were valid when it was fetched, not by today's list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def validity_intervals(changes: DataFrame) -> DataFrame:
    """Intervals [valid_from, valid_to) in which an entry is on its list.

    ``changes`` has ``entry`` (``host`` or ``host/path`` in lower case), ``category``,
    ``changed_at`` and ``action``. Per entry and category the state after a change holds
    until the next one; the last one has no end (null). Of changes at the same moment
    ``remove`` counts. Rows with a null entry, time or action, or another action, take no
    part; a null category is a category.
    """
    history = (
        changes.where(F.col("action").isin("add", "remove") & F.col("entry").isNotNull()
                      & F.col("changed_at").isNotNull())
        .groupBy("entry", "category", "changed_at")
        .agg(F.max("action").alias("action"))
    )
    following = Window.partitionBy("entry", "category").orderBy("changed_at")
    return (
        history.withColumn("valid_to", F.lead("changed_at").over(following))
        .where(F.col("action") == "add")
        .select("entry", "category", F.col("changed_at").alias("valid_from"), "valid_to")
    )


def url_host(url: Column) -> Column:
    """Host in lower case without user, port, and trailing dot; null if there is none."""
    authority = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r"\.?(:[0-9]*)?$", "")
    return F.nullif(host, F.lit(""))


def lookup_keys(url: Column, host: Column, max_labels: int, max_segments: int) -> Column:
    """What an entry may be called to match a URL.

    The host and its parent domains down to two labels, and the host followed by each
    leading run of path segments; domains of more than ``max_labels`` labels and runs of more
    than ``max_segments`` segments are left out.
    """
    labels = F.split(host, r"\.")
    tails = F.transform(
        F.sequence(F.lit(2), F.greatest(F.lit(2), F.least(F.lit(max_labels), F.size(labels)))),
        lambda n: F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - n + 1), n), "."),
    )
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    heads = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(max_segments)), lambda n: (n > 0) & (n <= F.size(segments))),
        lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, n), "/")),
    )
    return F.array_distinct(F.concat(tails, F.array(host), heads))


def filter_captures(
    captures: DataFrame,
    changes: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    time_column: str = "fetched_at",
) -> DataFrame:
    """Judges every capture by the list entries that were valid when it was fetched.

    Returns one row per capture: the id, ``host``, the time, ``blocked`` and ``matches`` (sorted
    distinct ``category:entry`` strings of all valid entries). Null, empty or hostless URLs
    and captures without a time match nothing and are not blocked. Repeated rows are judged
    once each and stay.

    Keys of distinct (URL, time) pairs are joined, so repeated captures cost no more, and
    matches are combined per pair; a hot host meets only its own few entries. Keys are made no
    longer than the longest entries of the list, whatever their length.
    """
    rows = captures.select(
        F.col(id_column).alias("capture_id"), F.col(url_column).cast("string").alias("url"),
        F.col(time_column).alias("fetched"),
    )
    intervals = validity_intervals(changes)
    parts = F.split("entry", "/")
    longest = changes.where(F.col("entry").isNotNull()).agg(
        F.max(F.size(F.split(parts[0], r"\."))).alias("labels"), F.max(F.size(parts) - 1).alias("segments")).first()
    max_labels, max_segments = longest["labels"] or 0, longest["segments"] or 0
    asked = rows.select("url", "fetched").distinct().withColumn("host", url_host(F.col("url")))
    keyed = asked.where(F.col("host").isNotNull() & F.col("fetched").isNotNull()).select(
        "url", "fetched", F.explode(lookup_keys(F.col("url"), F.col("host"), max_labels, max_segments)).alias("key"))
    valid = (
        (F.col("key") == F.col("entry"))
        & (F.col("fetched") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    )
    found = keyed.join(intervals, valid).groupBy("url", "fetched").agg(
        F.array_sort(F.collect_set(F.concat_ws(":", "category", "entry"))).alias("matches"))
    judged = rows.join(
        found.withColumnsRenamed({"url": "found_url", "fetched": "found_at"}),
        (F.col("url") == F.col("found_url")) & (F.col("fetched") == F.col("found_at")), "left")
    return judged.select(
        F.col("capture_id").alias(id_column), url_host(F.col("url")).alias("host"),
        F.col("fetched").alias(time_column), F.col("matches").isNotNull().alias("blocked"),
        F.coalesce("matches", F.array().cast("array<string>")).alias("matches"),
    )
