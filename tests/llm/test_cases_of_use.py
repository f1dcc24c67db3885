"""Cases met in use: planted values, odd lists and items, plain versions of the learned models."""

from __future__ import annotations

import datetime
import math
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardlake.llm import decontaminate, language_id, pii, queries, toxicity, url_filters

SF_DIR = "/root/testdata/sf0.001"


# --- 4 URL filters --------------------------------------------------------------------

def test_entries_of_any_length_match(spark):
    deep = "a.co/" + "/".join(map(str, range(1, 12)))
    wide = ".".join("bcdefghijk") + ".org"
    changes = spark.createDataFrame(
        [(deep, "x", 1, "add"), (wide, "x", 1, "add"), ("single", "x", 1, "add")],
        "entry string, category string, changed_at int, action string")
    urls = {1: f"http://{deep}/more?q=1", 2: f"https://www.a.{wide}/", 3: "http://a.co/1/2/3", 4: f"http://{wide[2:]}/", 5: "http://single/"}
    captures = spark.createDataFrame([(i, u, 5) for i, u in urls.items()], "page_id long, url string, fetched_at int")
    found = {r["page_id"]: r["blocked"] for r in url_filters.filter_captures(captures, changes).collect()}
    assert found == {1: True, 2: True, 3: False, 4: False, 5: True}
    assert url_filters.filter_captures(captures, changes.where("false")).where("blocked").isEmpty()


# --- 6 language ID --------------------------------------------------------------------

def _plain_language(model, text):
    """Nearest centroid by loops over n-grams and centroids."""
    counts = language_id.text_vector(text)
    if counts is None:
        return "und", 0.0
    weights = {s: math.log1p(int(counts[s])) * float(model.idf[s]) for s in np.flatnonzero(counts).tolist()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    cosines = [sum(w * float(c[s]) for s, w in weights.items()) / norm for c in model.centroids]
    best = max(range(len(cosines)), key=cosines.__getitem__)
    return model.languages[best], min(1.0, max(0.0, cosines[best]))


def test_language_query_equals_a_plain_nearest_centroid(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    model = language_id.fit(docs.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    assert all(abs(np.linalg.norm(c) - 1) < 1e-5 for c in model.centroids)
    rows = {r["doc_id"]: r for r in queries.op6_language_id(spark, SF_DIR).collect()}
    for i, text in ((r["doc_id"], r["text"]) for r in docs.collect()):
        language, score = _plain_language(model, text)
        assert abs(rows[i]["score"] - score) < 1e-4
        assert rows[i]["lang_pred"] == language or abs(rows[i]["score"] - score) < 1e-5


def test_numerals_are_no_language(spark):
    docs = queries.table(spark, SF_DIR, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    odd = spark.createDataFrame([(1, "²³ ½"), (2, "ⅠⅡ"), (3, "12 _ 7"), (4, None), (5, ""), (6, "١٢"), (7, "a²")],
                                "doc_id long, text string")
    found = {r["doc_id"]: r["lang_nearest"] for r in language_id.identify(odd, model).collect()}
    assert all(found[i] == "und" for i in range(1, 7)) and found[7] != "und"


def test_many_languages_stay_within_the_bounds(spark):
    rows = [(i, f"w{i % 40} x{i % 40}y z{i % 40} tail", f"l{i % 40:02d}") for i in range(400)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_languages=7, sample_texts=30)
    assert sorted(set(model.languages)) == [f"l{i:02d}" for i in range(7)]


# --- 7 toxicity -----------------------------------------------------------------------

def _pairs(count, seed, words):
    """Texts in which two terms, each in half of them, tell only together."""
    draw, rows, labels = random.Random(seed), [], []
    for i in range(count):
        a, b = draw.random() < 0.5, draw.random() < 0.5
        text = [f"w{draw.randint(0, words)}" for _ in range(8)] + ["insult"] * a + ["group"] * b
        draw.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(a == b)))
    return rows, labels


def _auc(scores, labels):
    toxic, clean = (np.array([s for s, y in zip(scores, labels) if y == k]) for k in (1, 0))
    return float(np.mean(toxic[:, None] > clean[None, :]))


def test_terms_that_tell_only_together_are_learned(spark):
    rows, labels = _pairs(3000, 7, 200)
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels[:2400], "doc_id long, toxic int")
    machine = toxicity.fit(known, docs, rounds=300)
    truth = [y for _, y in labels[2400:]]
    assert _auc(machine.score_texts([t for _, t in rows[2400:]]), truth) > 0.9
    machine.factors[:] = 0  # without pairs nothing is left of it
    assert _auc(machine.score_texts([t for _, t in rows[2400:]]), truth) < 0.6


@pytest.mark.parametrize("sf, least", [("sf0.01", 0.8), ("sf0.1", 0.9)])
def test_pairs_do_not_lower_what_weights_reach(spark, sf, least):
    sf_dir = f"/root/testdata/{sf}"
    labels = {r["doc_id"]: r["toxic"] for r in queries.table(spark, sf_dir, "labels").collect()}
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0 and i in texts]
    known = queries.table(spark, sf_dir, "labels").where("crc32(cast(doc_id as string)) % 5 <> 0")
    docs = queries.table(spark, sf_dir, "documents")
    reached = [
        _auc(toxicity.fit(known, docs, rounds=rounds).score_texts([texts[i] for i in held]), [labels[i] for i in held])
        for rounds in (0, 120)]
    assert reached[1] >= least and reached[1] >= reached[0] - 1e-3


def test_margins_equal_plain_loops():
    draw = np.random.default_rng(3)
    feature = np.full(toxicity.SLOTS, -1, dtype=np.int32)
    texts = ["alpha beta gamma", "", "beta beta delta alpha epsilon", None, "zeta"]
    slots = sorted({int(s) for t in texts if t for s in toxicity._terms([t.encode()])[0]})[::2]
    feature[slots] = np.arange(len(slots))
    machine = toxicity.FactorizationMachine(feature, -0.3, draw.normal(size=len(slots)), draw.normal(size=(len(slots), 3)))
    for text, score in zip(texts, machine.score_texts(texts)):
        own = sorted({int(feature[s]) for s in toxicity._terms([(text or "").encode()])[0] if feature[s] >= 0})
        margin = machine.bias + sum(machine.weights[i] for i in own)
        margin += sum(float(machine.factors[i] @ machine.factors[j]) for i in own for j in own if i < j) / max(1, len(own))
        assert abs(score - 1 / (1 + math.exp(-margin))) < 1e-9


def test_toxicity_query_equals_plain_loops(spark):
    """The scores of the query from its own machine, text by text."""
    docs = queries.table(spark, SF_DIR, "documents")
    known = queries.table(spark, SF_DIR, "labels").where("crc32(cast(doc_id as string)) % 5 <> 0")
    machine = toxicity.fit(known, docs)
    rows = {r["doc_id"]: r["score"] for r in queries.op7_toxicity(spark, SF_DIR).collect()}
    for r in docs.limit(60).collect():
        slots = {int(s) for s in toxicity._terms([r["text"].lower().encode()])[0]}
        own = sorted({int(machine.feature[s]) for s in slots if machine.feature[s] >= 0})
        v = machine.factors[own].astype(float)
        margin = machine.bias + machine.weights[own].sum() + (
            float((v.sum(axis=0) ** 2).sum() - (v**2).sum()) / (2 * max(1, len(own))) if own else 0.0)
        assert abs(rows[r["doc_id"]] - 1 / (1 + math.exp(-margin))) < 1e-6


# --- 8 decontamination ----------------------------------------------------------------

def test_items_without_an_id_and_of_one_id_are_all_searched(spark):
    passages = [
        "How many rivers cross the old border town in the north? Seven of them do so every spring.",
        "Which painter left the guild after the flood had ruined his second workshop? Anna of Delft did.",
        "What did the harbour master write into the ledger on the last day of winter? Only the word ice.",
    ]
    benchmark = spark.createDataFrame(
        [(1, passages[0]), (1, passages[1]), (None, passages[2]), (1, passages[0]), (2, None)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(i, f"Before it all. {p} After it all.") for i, p in enumerate(passages)] + [(9, "Nothing of the kind is in here.")],
        "doc_id long, text string")
    found = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert found == {0: [1], 1: [1], 2: [None], 9: []}


# --- 10 pseudonyms --------------------------------------------------------------------

def _all_dates(written):
    day = datetime.date(1900, 1, 1)
    while day.year < 2100:
        yield written(day)
        day += datetime.timedelta(days=1)


@pytest.mark.parametrize("written", [
    lambda d: d.isoformat(), lambda d: f"{d.day:02d}/{d.month:02d}/{d.year}", lambda d: f"{d.day}.{d.month}.{d.year}",
    lambda d: f"{d.month:02d}/{d.day:02d}/{d.year}", lambda d: f"{d.month}/{d.day}/{d.year}", lambda d: f"{d.day}/{d.month:02d}/{d.year}",
    lambda d: f"{d.month:02d}.{d.day}.{d.year}"])
def test_no_two_dates_get_one_pseudonym_and_all_come_back(written):
    there, back = pii.Pseudonymiser(b"k"), pii.Pseudonymiser(b"k", back=True)
    values = sorted(set(_all_dates(written)))
    new = [there.date(v) for v in values]
    assert len(set(new)) == len(values)
    for value, other in zip(values[::7], new[::7]):
        assert other != value and back.date(other) == value
        a, b = (x.replace(".", "/").replace("-", "/").split("/") for x in (value, other))
        if "-" not in value:
            assert pii.date_style(*a[:2]) == pii.date_style(*b[:2])


def test_dates_of_both_orders_stay_apart():
    worker = pii.Pseudonymiser(b"k")
    values = sorted({*_all_dates(lambda d: f"{d.day:02d}/{d.month:02d}/{d.year}"), *_all_dates(lambda d: f"{d.month:02d}/{d.day:02d}/{d.year}")})
    assert len({worker.date(v) for v in values}) == len(values)


def test_texts_come_back(spark):
    texts = ["Born 5/3/2024 or 05.03.2024, mail %x.y%z@site.org and a@b.co, card 4111 1111 1111 1111", None, "none",
             "078-05-1120, 10.0.0.7, +44 20 7946 0958, GB82 WEST 1234 5698 7654 32, 2001-02-28"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("pseudonyms", F.lit(1))
    hidden = pii.pseudonymise(docs, b"key")
    assert all(r["text"] != texts[r["doc_id"]] for r in hidden.where("doc_id in (0, 3)").collect())
    again = pii.pseudonymise(hidden, b"key", back=True)
    assert {r["doc_id"]: r["text"] for r in again.collect()} == dict(enumerate(texts))
    assert again.where("pseudonyms <> 1").isEmpty()


@pytest.mark.parametrize("piece", ["a%", "a.", "a-", "%", "a@", "1 ", "a_", "+1", "1-", "(1"])
def test_long_runs_take_no_long_time(piece):
    begin = time.monotonic()
    pii.Pseudonymiser(b"k").apply("1@ " + piece * (1_000_000 // len(piece)))
    assert time.monotonic() - begin < 20


# --- stages ---------------------------------------------------------------------------

def test_stages_hand_on_all_columns_by_value_and_type(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    for name in ("_pii", "_language", "leaks", "lang_rejected", "lang_nearest", "pii_email", "dropped", "copies", "row_key", "repeated"):
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")))
    for name, step in corpus_pipeline.STAGES:
        result = step(spark, docs, SF_DIR)
        given, got = ({f.name: f.dataType for f in df.schema} for df in (docs, result))
        assert {k: got[k] for k in given} == given, name
        same = [c for c in docs.columns if c not in ("text", "n_chars", "lang")]
        kept = result.select(same).distinct()
        assert not kept.isEmpty() and kept.exceptAll(docs.select(same)).isEmpty(), name
