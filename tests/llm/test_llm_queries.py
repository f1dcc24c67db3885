"""The registered training-data queries against their SQL, or against brute force."""

from __future__ import annotations

import zlib
from collections import Counter

import compare
import numpy as np
import pytest

import corpus_pipeline
from cardlake.llm import mixing, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duckdb():
    return compare.duckdb_connection(SF_DIR)


@pytest.fixture(scope="module")
def documents(duckdb):
    return duckdb.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_its_sql(spark, duckdb, name):
    df = queries.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan
    found = compare.spark_result(df)
    assert found[1]
    assert compare.difference(found, compare.duckdb_result(duckdb, queries.statements()[name])) is None


def test_preference_query_is_native(spark):
    plan = queries.op5_preference_format(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_token_counts_equal_the_library(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    wanted = {}
    for i, text, *_ in documents:
        n = len(library.encode(text, add_special_tokens=False).ids)
        wanted[i] = (len(text.encode()), n, n > queries.TOKEN_LIMIT)
    rows = queries.op1_token_counts(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == wanted
    texts = {i: text for i, text, *_ in documents}
    for r in rows[::20]:
        cut = texts[r["doc_id"]].encode()[:r["budget_bytes"]].decode()
        assert len(library.encode(cut, add_special_tokens=False).ids) <= queries.TOKEN_LIMIT


def test_language_accuracy_on_the_held_out_fold(spark, documents):
    languages = {i: lang for i, _, lang, _ in documents}
    rows = queries.op6_language_id(spark, SF_DIR).collect()
    assert len(rows) == len(documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == languages[r["doc_id"]] for r in held]) >= 0.95
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_toxicity_on_the_held_out_fold(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in queries.table(spark, sf_dir, "labels").collect()}
    rows = queries.op7_toxicity(spark, sf_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [r["score"] for r in held if labels[r["doc_id"]] == 1]
    clean = [r["score"] for r in held if labels[r["doc_id"]] == 0]
    assert np.mean([a > b for a in toxic for b in clean]) >= 0.8


def test_leaks_equal_a_plain_search(spark, duckdb, documents):
    items = duckdb.execute("SELECT item_id, text FROM benchmark").fetchall()
    plain = lambda text: " ".join(text.lower().split())
    contained = {(d, i) for d, text, *_ in documents for i, item in items if plain(item) in plain(text)}
    found = {(r["doc_id"], r["item_id"]) for r in queries.op8_decontaminate(spark, SF_DIR).collect()}
    assert contained <= found
    texts, asked = {d: plain(t) for d, t, *_ in documents}, dict(items)
    for d, i in found - contained:  # altered passages still share most words in order
        words = plain(asked[i]).split()
        assert sum(" ".join(words[k:k + 2]) in texts[d] for k in range(len(words) - 1)) >= 0.6 * (len(words) - 1)


def test_pseudonyms_change_documents_with_values_only(spark, documents):
    rows = queries.op10_pii_pseudonyms(spark, SF_DIR).collect()
    texts = {i: text for i, text, *_ in documents}
    assert len(rows) == len(texts)
    for r in rows:
        values = sum(r[c] for c in r.asDict() if c.startswith("pii_"))
        assert (r["text"] != texts[r["doc_id"]]) == (values > 0)


def _jaccard_classes(texts, size, percent):
    """Smallest linked id per document, by comparing all pairs."""
    sets = {}
    for i, text in texts.items():
        words = text.translate({c: c + 32 for c in range(65, 91)}).split()
        grams = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)}
        sets[i] = grams if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_pipeline_equals_a_brute_force_run(spark, duckdb, documents):
    docs = queries.table(spark, SF_DIR, "documents")
    first = corpus_pipeline.identify_language(spark, docs, SF_DIR)
    spoken = {r["doc_id"]: r["lang"] for r in first.collect()}
    assert len(spoken) >= 0.98 * len(documents)  # all of these have a language
    texts = {i: text for i, text, *_ in documents if i in spoken}
    classes = _jaccard_classes(texts, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILAR_PERCENT)
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    leaks = {r["doc_id"] for r in queries.op8_decontaminate(spark, SF_DIR).collect()}
    texts = {i: t for i, t in texts.items() if i not in leaks}
    hidden = {r["doc_id"]: r["text"] for r in queries.op10_pii_pseudonyms(spark, SF_DIR).collect()}
    texts = {i: hidden[i] for i in texts}
    sources = {i: source for i, _, _, source in documents}
    left = spark.createDataFrame([(i, t, sources[i]) for i, t in texts.items()], "doc_id long, text string, source string")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(left, queries.MIX_WEIGHTS).collect()}
    wanted = sorted((i, k + 1, texts[i], spoken[i]) for i, n in copies.items() for k in range(n))
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["copy"], r["text"], r["lang"]) for r in rows) == wanted


def test_pipeline_keeps_rows_without_id_and_counts_repeated_ids_once(spark, tmp_path):
    F = queries.F
    docs = queries.table(spark, SF_DIR, "documents").withColumn(
        "doc_id", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 1, F.col("doc_id")))
    docs.union(docs.where("doc_id % 3 = 0")).union(docs.where("doc_id % 3 = 0")).write.parquet(f"{tmp_path}/documents.parquet")
    queries.table(spark, SF_DIR, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = queries.table(spark, str(tmp_path), "documents")
    for _, step in corpus_pipeline.STAGES[:-1]:
        given = corpus_pipeline.stage(step(spark, given, str(tmp_path)), "given")
    kept = given.collect()
    named = [r["doc_id"] for r in kept if r["doc_id"] is not None]
    assert len(named) == len(set(named)) and len(named) < len(kept)
    # The mix alone takes repeated ids too: each row by itself.
    for rows in (kept, kept + [r for r in kept if r["doc_id"] is not None]):
        docs = spark.createDataFrame(rows, given.schema)
        shares = {r["source"]: r["target"] / r["source_size"] for r in mixing.mix(docs, queries.MIX_WEIGHTS).collect()}
        lines, taken = Counter((r["doc_id"], r["text"], r["source"]) for r in rows), Counter()
        for r in corpus_pipeline.mix_sources(spark, docs, SF_DIR).collect():
            taken[r["doc_id"], r["text"], r["source"]] += 1
        assert any(i is None for i, *_ in taken)
        for line, n in lines.items():
            rate = shares[line[2]]
            assert n * np.floor(rate) <= taken[line] <= n * np.ceil(rate)
    final = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    once = corpus_pipeline.mix_sources(spark, spark.createDataFrame(kept, given.schema), SF_DIR)
    assert final == Counter((r["doc_id"], r["text"]) for r in once.collect())


def test_stages_return_the_columns_of_documents(spark):
    docs = queries.table(spark, SF_DIR, "documents").withColumn("_pii", queries.F.lit(1)).withColumn("leaks", queries.F.lit("x"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SF_DIR).columns == docs.columns, name


def test_stages_take_an_empty_table(spark):
    docs = queries.table(spark, SF_DIR, "documents").where("false")
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF_DIR).count() == 0, name
