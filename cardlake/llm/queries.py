"""The registered queries of the training-data operators, with production parameters.

Each query reads whole tables and applies one operator of this package; the columns of its
contract are derived from the operator's output. ``statements`` has SQL for those that SQL
can express over the given tables.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardlake.llm import (
    centroid_search, chat, decontaminate, embedding_dedup, fill_in_middle, language_id, main_text, mixing, ngram_join, pii,
    token_counts, toxicity, url_filters,
)

TOKEN_LIMIT = 512
MIX_WEIGHTS = (1.0, 2.0, 3.0)
# The key of the registered query; a user passes a secret one.
QUERY_KEY = b"query-key-for-tests-only"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """The byte-level vocabulary, as installed on this machine and on every executor."""
    configured = os.environ.get("CARDLAKE_VOCABULARY")
    if configured:
        return configured
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and how many bytes of it fit into the token limit."""
    counted = token_counts.prefix_token_counts(
        table(spark, sf_dir, "documents"), vocabulary_path(), TOKEN_LIMIT, keep_prefixes=False)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "budget_bytes")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


def _number(text: Column) -> Column:
    """A number below 65536 that depends on the text alone."""
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int")


def url_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day spread over one year, which the table lacks."""
    day = F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int")
    return pages.withColumn("fetched_at", F.date_add(F.lit("2024-01-01").cast("date"), day))


def url_list(pages: DataFrame) -> DataFrame:
    """A dated list over hosts and their first path segments, derived from the pages.

    A third of the hosts is added on some day, half of those are removed 60 days on and every
    fifth of the removed comes back after 60 more; of the first segments a fourth is added.
    """
    url = F.col("url")
    host = url_filters.url_host(url)
    segment = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    hosts = pages.select(host.alias("entry")).where("entry IS NOT NULL").distinct().withColumn("x", _number(F.col("entry")))
    paths = pages.where(host.isNotNull() & (segment != "")).select(
        F.concat(host, F.lit("/"), segment).alias("entry")).distinct().withColumn("x", _number(F.col("entry")))
    steps = ((0, "add", "x % 3 = 0"), (60, "remove", "x % 6 = 0"), (120, "add", "x % 30 = 0"))
    changes = [
        hosts.where(rule).select(
            "entry", F.lit("host").alias("category"),
            F.expr(f"date_add(date'2024-01-01', x % 200 + {days})").alias("changed_at"), F.lit(action).alias("action"))
        for days, action, rule in steps
    ]
    changes.append(paths.where("x % 4 = 0").select(
        "entry", F.lit("path").alias("category"),
        F.expr("date_add(date'2024-01-01', x % 300)").alias("changed_at"), F.lit("add").alias("action")))
    result = changes[0]
    for other in changes[1:]:
        result = result.union(other)
    return result


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries of its fetch day."""
    pages = table(spark, sf_dir, "pages")
    return url_filters.filter_captures(url_captures(pages), url_list(pages)).select(
        "page_id", "host", "fetched_at", "blocked", F.array_join("matches", " ").alias("matches"))


def preference_turns(conversations: DataFrame) -> DataFrame:
    """Pairs from stored conversations: the rejected side cuts the last answer short.

    The chosen side is the conversation as it is. On the rejected side only the first
    sentence of its last assistant turn is left.
    """
    last = F.max(F.when(F.col("role") == "assistant", F.col("turn"))).over(Window.partitionBy("conv_id"))
    rows = conversations.select("conv_id", "turn", "role", "text", last.alias("last"))
    cut = F.when((F.col("role") == "assistant") & (F.col("turn") == F.col("last")),
                 F.substring_index("text", ".", 1)).otherwise(F.col("text"))
    side = F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
        F.struct(F.lit("rejected").alias("side"), cut.alias("text")),
    )).alias("s")
    return rows.select(F.col("conv_id").alias("pair_id"), "turn", "role", side).select("pair_id", "turn", "role", "s.*")


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and completions of a preference pair per conversation."""
    turns = preference_turns(table(spark, sf_dir, "conversations"))
    covered = lambda spans: F.aggregate(
        spans, F.lit(0), lambda total, s: total + s["end"] - s["begin"]).cast("long")
    return chat.format_preferences(turns).select(
        F.col("pair_id").alias("conv_id"), F.col("prefix_turns").cast("long").alias("prefix_turns"),
        "prompt", "chosen", "rejected", covered("chosen_spans").alias("chosen_trained"),
        covered("rejected_spans").alias("rejected_trained"), "status")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from three of four."""
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"), 4, 2)
    model = language_id.fit(docs.where(~held_out))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), F.col("lang_nearest").alias("lang_pred"),
        F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four of five."""
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"), 5, 0)
    machine = toxicity.fit(table(spark, sf_dir, "labels").where(~held_out), docs)
    return toxicity.score(docs.select("doc_id", "text"), machine).select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each benchmark item that a document holds."""
    found = decontaminate.find_leaks(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents by Jaccard similarity of 4-word shingles, 85 % or more."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), 4, 85).select(
        "doc_id", F.col("n_ngrams").alias("n_shingles"), "component_id")


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for its personal data."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), QUERY_KEY)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every document is cut into prefix, middle and suffix, and that it can be restored."""
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=7)
    return made.select(
        "doc_id", F.col("fim_units").alias("n"), F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"), F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2("fim_output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("fim_output"), F.col("fim_form")), 256).alias("restored_sha256"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the embeddings, with the inertia of each cluster and of all."""
    found = centroid_search.cluster(
        table(spark, sf_dir, "embeddings"), k=8, rounds=10, dimension=64, scale=1024, seed=3)
    sums = found.assigned.where("cluster IS NOT NULL").groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(19,0)")).alias("sum"))
    written = [(number, ",".join(map(str, c))) for number, c in enumerate(found.centroids.tolist())]
    digests = spark.createDataFrame(written, "number int, written string").select(
        "number", F.sha2("written", 256).alias("centroid_sha256"))
    # One row per centroid, no more than the operator accepts.
    clusters = digests.join(sums, F.col("number") == F.col("cluster"), "left").select(
        "number", "centroid_sha256", F.col("sum").cast("long").alias("cluster_inertia"),
        F.sum("sum").over(Window.partitionBy(F.lit(0))).cast("long").alias("inertia"))
    return found.assigned.join(F.broadcast(clusters), F.col("cluster") == F.col("number"), "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_counts, op2_source_mix, op3_embedding_dedup, op4_url_filters, op5_preference_format,
        op6_language_id, op7_toxicity, op8_decontaminate, op9_ngram_join, op10_pii_pseudonyms,
        op11_fill_in_middle, op12_centroid_clusters, op13_main_text)}


_SOURCE_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), listed AS (
  SELECT source, sum(size) AS source_size, [1.0, 2.0, 3.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 3.0::DOUBLE * source_size AS lim,
    (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER w, 0.0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0))::DOUBLE AS level
  FROM listed
  WINDOW w AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), free AS (
  SELECT level FROM levels WHERE lim > level * weight ORDER BY lim / weight, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, least(lim, coalesce((SELECT level FROM free) * weight, lim)) AS target,
    (('0x' || substr(md5('mix' || coalesce('=' || source, '')), 1, 4))::INTEGER) / 65536.0::DOUBLE AS shift
  FROM levels
), ranked AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.shift,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, substr(md5(d.doc_id::VARCHAR), 1, 8), d.doc_id) AS n
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
  ((floor(n * rate + shift) - floor((n - 1) * rate + shift)) * size)::BIGINT AS taken
FROM ranked
"""

_EMBEDDINGS = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM v
  UNION SELECT l.a, r.seen FROM links l JOIN reach r ON l.b = r.node
)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id)::BIGINT AS n_links,
  min(r.seen) AS component_id, min(r.seen) = v.vec_id AS kept
FROM v JOIN reach r ON r.node = v.vec_id GROUP BY v.vec_id
"""

_URLS = r"""
WITH p AS (
  SELECT page_id, url, regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1) AS authority,
    string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/') AS path,
    DATE '2024-01-01' + ((page_id * 7919) % 365)::INTEGER AS fetched_at
  FROM pages
), c AS (
  SELECT page_id, fetched_at, nullif(regexp_replace(regexp_replace(authority, '^.*@', ''), '\.?(:[0-9]*)?$', ''), '') AS host,
    list_filter(path, lambda x: x <> '') AS segments
  FROM p
), keys AS (
  SELECT DISTINCT page_id, host, fetched_at, unnest(
    [host] || [array_to_string(list_slice(string_split(host, '.'), -n, -1), '.') for n in range(2, len(string_split(host, '.')) + 1)]
    || [host || '/' || array_to_string(segments[1:n], '/') for n in range(1, len(segments) + 1)]) AS key
  FROM c WHERE host IS NOT NULL
), h AS (
  SELECT DISTINCT host AS entry, ('0x' || substr(md5(host), 1, 4))::INTEGER AS x FROM c WHERE host IS NOT NULL
), s AS (
  SELECT DISTINCT host || '/' || segments[1] AS entry, ('0x' || substr(md5(host || '/' || segments[1]), 1, 4))::INTEGER AS x
  FROM c WHERE host IS NOT NULL AND len(segments) > 0
), valid AS (
  SELECT entry, 'host' AS category, DATE '2024-01-01' + (x % 200) AS since,
    CASE WHEN x % 6 = 0 THEN DATE '2024-01-01' + (x % 200 + 60) END AS until FROM h WHERE x % 3 = 0
  UNION ALL SELECT entry, 'host', DATE '2024-01-01' + (x % 200 + 120), NULL FROM h WHERE x % 30 = 0
  UNION ALL SELECT entry, 'path', DATE '2024-01-01' + (x % 300), NULL FROM s WHERE x % 4 = 0
), found AS (
  SELECT page_id, list_sort(list(DISTINCT category || ':' || entry)) AS matches
  FROM keys JOIN valid ON key = entry AND fetched_at >= since AND (until IS NULL OR fetched_at < until) GROUP BY page_id
)
SELECT c.page_id, c.host, c.fetched_at, f.matches IS NOT NULL AS blocked, coalesce(array_to_string(f.matches, ' '), '') AS matches
FROM c LEFT JOIN found f ON f.page_id = c.page_id
"""

_PREFERENCES = """
WITH t AS (
  SELECT conv_id, turn, role, text, max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS last FROM conversations
), b AS (
  SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS chosen,
    coalesce(CASE WHEN role = 'assistant' AND turn = last THEN split_part(text, '.', 1) ELSE text END, '') AS rejected,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS p
  FROM t
), m AS (
  SELECT *, coalesce(min(CASE WHEN chosen <> rejected THEN p END) OVER (PARTITION BY conv_id), count(*) OVER (PARTITION BY conv_id) + 1) AS cut,
    '<|' || role || '|>' || chr(10) AS head, '<|end|>' || chr(10) AS tail FROM b
)
SELECT conv_id, max(cut) - 1 AS prefix_turns,
  coalesce(string_agg(head || chosen || tail, '' ORDER BY p) FILTER (p < cut), '') AS prompt,
  coalesce(string_agg(head || chosen || tail, '' ORDER BY p) FILTER (p >= cut), '') AS chosen,
  coalesce(string_agg(head || rejected || tail, '' ORDER BY p) FILTER (p >= cut), '') AS rejected,
  coalesce(sum(length(chosen) + 8) FILTER (p >= cut AND role = 'assistant'), 0)::BIGINT AS chosen_trained,
  coalesce(sum(length(rejected) + 8) FILTER (p >= cut AND role = 'assistant'), 0)::BIGINT AS rejected_trained,
  CASE WHEN count(*) FILTER (p >= cut) = 0 THEN 'same'
       WHEN count(*) FILTER (p >= cut AND role = 'assistant') > 0 THEN 'pair' ELSE 'one_sided' END AS status
FROM m GROUP BY conv_id
"""

_NGRAMS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 3], ' ') for i in range(1, len(words) - 2)] END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.size + y.size - n_both)
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT l.a, r.seen FROM links l JOIN reach r ON l.b = r.node
)
SELECT d.doc_id, coalesce(any_value(n.size), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.node = d.doc_id GROUP BY d.doc_id
"""


_MIDDLES = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines FROM documents
), r AS (
  SELECT *, len(lines) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(lines) + 1) AS x,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(lines) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
         WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d
), c AS (
  SELECT *, array_to_string(lines[1:least(x, y)], '') AS prefix, array_to_string(lines[least(x, y) + 1:greatest(x, y)], '') AS middle,
    array_to_string(lines[greatest(x, y) + 1:n], '') AS suffix FROM r
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""


def _clusters(rounds: int = 10) -> str:
    """Rounds of assignment and means, written out one after the other."""
    steps = ["""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64 AND len(embedding) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS n, v FROM (
    SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT 8))"""]
    assign = """
a{i} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d) AS distance, arg_min(n, d * 8 + n) AS n FROM (
    SELECT k.*, c.n, list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, c.v) + list_inner_product(c.v, c.v) AS d
    FROM kept k, c{i} c) GROUP BY row)"""
    mean = """
c{j} AS MATERIALIZED (
  SELECT c.n, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT n, list(mean ORDER BY p) AS v FROM (
      SELECT n, p, floor(sum(v[p]) / count(*)) AS mean FROM a{i}, range(1, 65) t(p) GROUP BY n, p) GROUP BY n) m USING (n))"""
    for i in range(rounds):
        steps += [assign.format(i=i), mean.format(i=i, j=i + 1)]
    steps.append(assign.format(i=rounds))
    return ",".join(steps) + f"""
SELECT a.vec_id, a.n::INTEGER AS cluster, a.distance::BIGINT AS distance,
  sum(a.distance) OVER (PARTITION BY a.n)::BIGINT AS cluster_inertia, sum(a.distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (n)
"""


def statements() -> dict[str, str]:
    """DuckDB SQL for the queries whose method comes down to a query over the tables."""
    return {
        "op2_source_mix": _SOURCE_MIX,
        "op3_embedding_dedup": _EMBEDDINGS,
        "op4_url_filters": _URLS,
        "op5_preference_format": _PREFERENCES,
        "op9_ngram_join": _NGRAMS,
        "op11_fill_in_middle": _MIDDLES,
        "op12_centroid_clusters": _clusters(),
    }
