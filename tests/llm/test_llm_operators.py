"""Edge cases of every operator: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import base64
import datetime
import math
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlake.llm import (
    chat, components, decontaminate, embedding_dedup, hashing, language_id, mixing, ngram_join, pii, queries,
    token_counts, toxicity, url_filters,
)

SCHEMA = "doc_id long, text string, lang string, source string"


def frame(spark, texts, lang="en", source="a"):
    rows = [(i, t, lang, source) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# --- 1 token counts -------------------------------------------------------------------

@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(queries.vocabulary_path())


def test_counts_of_all_prefixes_equal_the_library(counter):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'re", "'", "l", "é", "漢", "🙂", "1", "23", "-", "----", "!",
             "<|endoftext|>", "<|endo", "Don't", " 'll", " ", "́", "ing"]
    draw = random.Random(3)
    for _ in range(400):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 10)))
        counts, at = token_counts.counts_at_bytes(counter.prefixes(text)), 0
        assert len(counts) == len(text.encode()) + 1
        for i, c in enumerate(text):
            at += len(c.encode())
            assert counts[at] == len(library.encode(text[:i + 1], add_special_tokens=False).ids), repr(text[:i + 1])


def test_token_counts_of_odd_rows(spark):
    texts = [None, "", " ", "x" * 30_000, "word " * 60_000, "word"]
    docs = frame(spark, texts).withColumn("n_tokens", F.lit("clash")).union(
        spark.createDataFrame([(None, "word", "en", "a", "c"), (5, "word", "en", "a", "c")], SCHEMA + ", n_tokens string"))
    rows = token_counts.prefix_token_counts(docs, queries.vocabulary_path(), 3).collect()
    assert len(rows) == 8
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[0]["n_bytes"], by_id[0]["n_tokens"], by_id[0]["prefix_steps"]) == (0, 0, bytearray())
    assert by_id[1]["n_tokens"] == 0 and by_id[2]["n_tokens"] == 1
    assert by_id[4]["n_tokens"] >= 60_000 and len(by_id[4]["prefix_steps"]) == 300_000
    assert by_id[None]["n_tokens"] == by_id[5]["n_tokens"] == 1
    assert token_counts.prefix_token_counts(docs.where("false"), queries.vocabulary_path(), 3).count() == 0


def test_a_budget_is_met_and_not_undercut(counter):
    text = "Längere Wörter und 漢字 in one line. " * 30
    data, steps = text.encode(), counter.prefixes(text)
    counts = token_counts.counts_at_bytes(steps)
    for budget in (0, 1, 7, 50, 10_000):
        size = token_counts.bytes_within(data, steps, budget)
        data[:size].decode()
        assert counts[size] <= budget
        later = [i for i in range(size + 1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
        assert all(counts[i] > budget for i in later)


# --- 2 mixing -------------------------------------------------------------------------

def test_mix_meets_targets_and_repeats_itself(spark):
    draw = random.Random(1)
    rows = [(i, "w " * draw.randint(0, 40), "en", draw.choice(["b", "a", None, "ä", "big", "big", "big"]))
            for i in range(600)] + [(700, None, "en", "void"), (701, "", "en", "void"), (None, "a b", "en", "a"), (3, "a b", "en", "a")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("clash"))
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    size, taken, target = {}, {}, {}
    for r in found:
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert r["source_size"] >= r["size"] and r["taken"] <= 3 * r["size"]
    assert all(size[s] == next(r["source_size"] for r in found if r["source"] == s) for s in size)
    # The shares by definition: share by weight, fix what is above its limit, share again.
    weight = {s: (i % 3) + 1.0 for i, s in enumerate(sorted(size, key=lambda s: (s is None, (s or "").encode())))}
    fixed = {}
    while True:
        open_ = [s for s in size if s not in fixed]
        rest = sum(size.values()) - sum(fixed.values())
        shares = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if shares[s] > 3 * size[s]]
        if not above:
            break
        fixed |= {s: 3.0 * size[s] for s in above}
    for s in size:
        assert target[s] == pytest.approx((fixed | shares)[s])
        assert abs(taken[s] - target[s]) <= 2 * 40 + 1
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, found))
    assert mixing.mix(docs.where("false")).count() == 0


# --- 3 embeddings ---------------------------------------------------------------------

def brute_links(vectors, threshold):
    units = {}
    for i, v in vectors:
        if v and None not in v and all(map(math.isfinite, v)) and any(v):
            units[i] = np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64))
    links = {i: {j for j in units if j != i and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold} for i in units}
    component = {i: i for i, _ in vectors}
    changed = True
    while changed:
        changed = False
        for i, others in links.items():
            low = min([component[i], *(component[j] for j in others)])
            changed |= low != component[i]
            component[i] = low
    return {i: (len(links.get(i, ())), component[i], component[i] == i) for i, _ in vectors}


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_VECTORS", 40)
    random_ = np.random.default_rng(2)
    base = random_.normal(size=(120, 24))
    hot = base[0] + random_.normal(scale=0.12, size=(90, 24))
    near = base[1:60] + random_.normal(scale=0.2, size=(59, 24))
    vectors = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, hot, near, base[5:9], 2 * base[6:7]]))]
    vectors += [(900, None), (901, []), (902, [0.0] * 24), (903, [1.0, None]), (904, [float("nan")] * 24),
                (905, [float("inf")] + [0.0] * 23), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [1e300] * 24), (909, [1e-300] * 24)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("clash"))
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect()}
    wanted = brute_links(vectors[:-2], 0.9) | {908: (1, 908, True), 909: (1, 908, False)}
    right, links = 0, 0
    assert set(found) == set(wanted)
    for i in wanted:
        assert found[i][0] <= wanted[i][0]
        right, links = right + found[i][0], links + wanted[i][0]
    assert right >= 0.9 * links
    assert np.mean([found[i] == wanted[i] for i in wanted]) >= 0.9
    assert all(found[i] == wanted[i] for i in range(900, 910))
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0
    assert embedding_dedup.near_duplicates(df.where("vec_id = 900")).collect()[0]["n_links"] == 0


def test_links_found_from_one_side_count_on_both(spark, monkeypatch):
    """With next to no margin a link is often found from one side; both ends count it, once."""
    fitted = []

    def fit(*arguments):
        fitted.append(embedding_dedup_fit(*arguments))
        return fitted[-1]

    embedding_dedup_fit = embedding_dedup.fit
    monkeypatch.setattr(embedding_dedup, "fit", fit)
    monkeypatch.setattr(embedding_dedup, "BLOCK_VECTORS", 30)
    monkeypatch.setattr(embedding_dedup, "QUERY_CHUNK", 7)
    monkeypatch.setattr(embedding_dedup, "ASKED_BYTES", 1000)
    random_ = np.random.default_rng(8)
    base = random_.normal(size=(400, 16))
    vectors = np.concatenate([base, base + random_.normal(scale=0.4, size=base.shape), base[:40]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df, 0.9, margin=0.05).collect()}

    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    own, asked = fitted[0].lists(units)
    linked = units @ units.T >= 0.9
    np.fill_diagonal(linked, False)
    seen = linked & asked[:, own]
    equal = (vectors[:, None, :] == vectors[None, :, :]).all(axis=2)
    # Enough links are found from one side only.
    assert (seen != seen.T).sum() > 20
    both = seen | seen.T | (equal & linked)
    assert {i: found[i][0] for i in found} == dict(enumerate(both.sum(axis=1).tolist()))
    component = list(range(len(vectors)))
    for _ in component:
        component = [min([component[i], *(component[j] for j in np.flatnonzero(both[i]))]) for i in range(len(component))]
    assert [found[i][1] for i in range(len(vectors))] == component


def test_the_sample_is_the_lowest_hashes_however_it_is_cut(spark):
    heads = spark.range(5000).select(F.col("id").alias("vec_id"), F.col("id").cast("string").cast("binary").alias("unit"))
    whole = heads.select("unit", F.xxhash64("vec_id").alias("place")).orderBy("place").limit(300).collect()
    for rows in (5000, 400):
        assert [r["unit"] for r in embedding_dedup._sample(heads, rows, 300).collect()] == [r["unit"] for r in whole]


def test_recall_on_the_whole_sample_table(spark):
    rows = queries.table(spark, "/root/testdata/sf0.1", "embeddings").collect()
    units = np.array([r["embedding"] for r in rows], dtype=np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    wanted = {r["vec_id"]: int(n) for r, n in zip(rows, ((units @ units.T) >= 0.9).sum(axis=1) - 1)}
    found = {r["vec_id"]: r["n_links"] for r in queries.op3_embedding_dedup(spark, "/root/testdata/sf0.1").collect()}
    assert all(found[i] <= wanted[i] for i in wanted)
    assert sum(found.values()) >= 0.99 * sum(wanted.values())


# --- 4 URL filters --------------------------------------------------------------------

def test_captures_are_judged_by_the_list_of_their_day(spark):
    day = datetime.date
    changes = spark.createDataFrame([
        ("bad.org", "x", day(2024, 1, 10), "add"), ("bad.org", "x", day(2024, 2, 10), "remove"),
        ("bad.org", "x", day(2024, 3, 10), "add"), ("bad.org", "x", day(2024, 3, 10), "add"),
        ("a.co/p/q", "y", day(2024, 1, 1), "add"), ("tie.org", "x", day(2024, 1, 1), "add"), ("tie.org", "x", day(2024, 1, 1), "remove"),
        (None, "x", day(2024, 1, 1), "add"), ("none.org", "x", None, "add"), ("odd.org", "x", day(2024, 1, 1), None),
        ("null.org", None, day(2024, 1, 1), "add"),
    ], "entry string, category string, changed_at date, action string")
    cases = [
        ("http://sub.bad.org/x", day(2024, 1, 9), False), ("http://sub.bad.org/x", day(2024, 1, 10), True),
        ("HTTPS://u@BAD.org.:80/x", day(2024, 2, 9), True), ("http://bad.org", day(2024, 2, 10), False),
        ("http://bad.org?y", day(2024, 4, 1), True), ("http://verybad.org", day(2024, 4, 1), False),
        ("http://a.co/p/q/r?z", day(2024, 1, 1), True), ("http://a.co/p/qq", day(2024, 1, 1), False),
        ("http://tie.org", day(2024, 5, 1), False), ("http://null.org", day(2024, 5, 1), True),
        (None, day(2024, 4, 1), False), ("", day(2024, 4, 1), False), ("bad.org", day(2024, 4, 1), False),
        ("http://bad.org", None, False), ("http:///bad.org", day(2024, 4, 1), False), ("http://bad.org/" + "a/" * 20_000, day(2024, 4, 1), True),
    ]
    rows = [(i, url, when) for i, (url, when, _) in enumerate(cases)] + [(0, *cases[0][:2])]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at date").withColumn("host", F.lit("clash"))
    found = url_filters.filter_captures(captures, changes).collect()
    assert len(found) == len(rows)
    assert {r["page_id"]: r["blocked"] for r in found} == {i: blocked for i, (_, _, blocked) in enumerate(cases)}
    assert url_filters.filter_captures(captures.where("false"), changes).count() == 0
    assert not any(r["blocked"] for r in url_filters.filter_captures(captures, changes.where("false")).collect())


# --- 5 chat formatting ----------------------------------------------------------------

def test_preferences_share_their_prompt(spark):
    rows = [(1, s, 0, "user", "hi") for s in ("chosen", "rejected")] + [
        (1, "chosen", 1, "assistant", "good"), (1, "rejected", 1, "assistant", "bad"), (1, "rejected", 2, "user", "why"),
        (2, "chosen", 0, "user", "x"), (2, "rejected", 0, "user", "x"),
        (3, "chosen", 0, "assistant", "only"), (4, "chosen", 0, None, None), (4, "rejected", 0, "assistant", "z" * 200_000),
        (None, "chosen", 0, "assistant", "a"), (None, "rejected", 0, "assistant", "b"), (5, "other", 0, "user", "x"),
        (6, "chosen", 0, "assistant", "a"), (6, "chosen", 0, "assistant", "a"), (6, "rejected", 0, "assistant", "a"),
        (6, "rejected", None, "assistant", "first"),
    ]
    turns = spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string").withColumn("prompt", F.lit(1))
    found = {r["pair_id"]: r for r in chat.format_preferences(turns).collect()}
    assert set(found) == {1, 2, 3, 4, None, 6}
    one = found[1]
    assert one["prompt"] == "<|user|>\nhi<|end|>\n" and one["chosen"] == "<|assistant|>\ngood<|end|>\n"
    assert [one["rejected"][s["begin"]:s["end"]] for s in one["rejected_spans"]] == ["bad<|end|>\n"]
    assert (one["status"], found[2]["status"], found[3]["status"], found[4]["status"]) == ("pair", "same", "one_sided", "one_sided")
    assert found[4]["chosen"] == "<|user|>\n<|end|>\n" and found[None]["status"] == "pair"
    assert found[6]["prefix_turns"] == 0 and found[6]["status"] == "pair"
    assert chat.format_preferences(turns.where("false")).count() == 0


# --- 6 language -----------------------------------------------------------------------

def test_language_vectors_do_not_depend_on_windows(monkeypatch):
    text = "Ein längerer Text, mit vielen Wörtern. " * 50
    whole = language_id.text_vector(text)
    monkeypatch.setattr(hashing, "WINDOW_BYTES", 64)
    assert (language_id.text_vector(text) == whole).all()


def test_odd_texts_are_rejected_and_clean_ones_kept(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    odd = [None, "", "12345 !!! ...", "漢字" * 30, "the and of is was " * 40_000]
    asked = frame(spark, odd).withColumn("lang_score", F.lit("clash"))
    found = {r["doc_id"]: r for r in language_id.identify(asked, model).collect()}
    for i in (0, 1, 2):
        assert (found[i]["lang_nearest"], found[i]["lang_score"], found[i]["lang_rejected"]) == ("und", 0.0, True)
    assert found[3]["lang_rejected"] and found[3]["lang_nearest"] in model.languages
    assert not found[4]["lang_rejected"] and found[4]["lang_nearest"] == "en"
    assert language_id.identify(docs, model).where("lang_rejected").count() <= 0.002 * docs.count()
    assert language_id.identify(asked.where("false"), model).count() == 0
    empty = language_id.fit(docs.where("false"))
    assert {r["lang_nearest"] for r in language_id.identify(asked, empty).collect()} == {"und"}


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
    "i powinni postępować wobec innych w duchu braterstwa.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
    "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı "
    "kardeşlik zihniyeti ile hareket etmelidirler.",
]


def test_foreign_text_and_letter_junk_are_rejected_at_any_length(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    draw = random.Random(3)
    made = lambda letters, n: " ".join("".join(draw.choices(letters, k=draw.randint(3, 9))) for _ in range(n))
    junk = [made(letters, n) for letters in ("0123456789abcdef", "bcdfghjklmnpqrstvwxz", string.ascii_lowercase) for n in (15, 60, 600)]
    junk += [base64.b64encode(draw.randbytes(n)).decode() for n in (60, 600, 6000)]
    asked = frame(spark, [" ".join(t.split()[:n]) for t in FOREIGN for n in (8, 15, 100)] + junk)
    assert language_id.identify(asked, model).where("NOT lang_rejected").count() == 0
    for n in (1, 3, 10, 30):  # beginnings of clean texts
        short = docs.withColumn("text", F.array_join(F.slice(F.split("text", " "), 1, n), " ")).where("text rlike '[a-zA-Z]'")
        assert language_id.identify(short, model).where("lang_rejected").count() <= 0.02 * short.count(), n


# --- 7 toxicity -----------------------------------------------------------------------

def test_the_machine_learns_what_no_sum_can(spark):
    draw, rows, labels = random.Random(5), [], []
    for i in range(1200):  # toxic where both or neither occur: a sum gets 84 % at best
        a, b = draw.random() < 0.6, draw.random() < 0.6
        words = [f"w{draw.randint(0, 60)}" for _ in range(8)] + ["insult"] * a + ["praise"] * (not a) + ["group"] * b + ["nobody"] * (not b)
        draw.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(a == b)))
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit(known, docs, rounds=300)
    truth = dict(labels)
    scores = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, machine).collect()}
    assert np.mean([(scores[i] >= 0.5) == truth[i] for i in truth]) >= 0.95


def test_toxicity_of_odd_rows(spark):
    docs = frame(spark, [None, "", "bad " * 50_000, "good", "bad"]).withColumn("toxicity", F.lit("clash"))
    labels = spark.createDataFrame([(2, 1), (3, 0), (4, 1), (4, 1), (None, 1), (1, None), (0, 7)], "doc_id long, toxic int")
    for known in (labels, labels.where("toxic = 1"), labels.where("false")):
        scores = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, toxicity.fit(known, docs)).collect()}
        assert len(scores) == 5 and all(0.0 <= s <= 1.0 for s in scores.values()) and scores[0] == scores[1]
    assert toxicity.score(docs.where("false"), toxicity.fit(labels, docs)).count() == 0


# --- 8 decontamination ----------------------------------------------------------------

def plain_scores(index, texts, threshold):
    """All (passage, item) scores from the postings, without any bound."""
    weights = {}
    for t, (low, high) in enumerate(zip(index.block_start[:-1], index.block_start[1:])):
        for entry in range(low, high):
            for p in range(index.posting_start[entry], index.posting_start[entry + 1]):
                weights.setdefault(int(index.terms[t]), {})[int(index.posting_item[p])] = index.posting_weight[p]
    found = set()
    for w, terms in enumerate(texts):
        scores = {}
        for t in set(terms):
            for item, weight in weights.get(t, {}).items():
                scores[item] = scores.get(item, 0.0) + weight
        found |= {(w, item) for item, s in scores.items() if s >= threshold}
    return found


def test_retrieval_is_exact():
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(draw.choices(vocabulary, weights=range(1, 81), k=draw.randint(3, 30)))) for i in range(60)]
    index = decontaminate.build_index(items, {}, len(items), 15.0)
    texts = [draw.choices(vocabulary, k=40) for _ in range(50)] + [text.split() for _, text in items[:20]]
    hashed = [decontaminate._words(" ".join(t)).tolist() for t in texts]
    place = {t: k for k, t in enumerate(index.terms.tolist())}
    pairs = sorted({(w, place[t]) for w, terms in enumerate(hashed) for t in terms if t in place})
    window, term = (np.array(x) for x in zip(*pairs))
    for threshold in (0.2, 0.4, 0.7):
        found = decontaminate.retrieve(index, window, term, threshold)
        assert set(zip(found[0].tolist(), found[1].tolist())) == plain_scores(index, hashed, threshold)


def test_leaks_in_odd_rows(spark, monkeypatch):
    item = "Which river flows through the old town of Passau before it meets the sea? The answer is the long Danube river."
    benchmark = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (4, "?!"), (None, "some text of a null item"), (5, " ".join(f"x{c}" for c in "abcdefghij") * 30)],
        "item_id long, text string").withColumn("leaks", F.lit(1))
    noise = "of the and to in it is was that for on with as by at from " * 3_000
    docs = frame(spark, [None, "", noise, noise + item.upper() + noise, item[:40], item, item]).withColumn("leaks", F.lit("clash"))
    for shard in (20_000, 1):
        monkeypatch.setattr(decontaminate, "SHARD_ITEMS", shard)
        found = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in decontaminate.find_leaks(docs, benchmark).collect()}
        assert found == {0: [], 1: [], 2: [], 3: [1], 4: [], 5: [1], 6: [1]}
    assert decontaminate.find_leaks(docs.where("false"), benchmark).count() == 0
    assert all(not r["leaks"] for r in decontaminate.find_leaks(docs, benchmark.where("false")).collect())


def test_numbers_are_compared(spark):
    template = "A farmer keeps {} hens and buys {} more at the market on the way home. How many hens does the farmer keep now? {}"
    items = ["What is 12 plus 30? 42", template.format(14, 17, 31), "12 + 30 = 42", "Round the number of Archimedes to two places. 3.14",
             "Which river flows through the old town of Passau? ???"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    clean = ["What is 15 plus 20? 35", "What is 12 plus 30? 43", template.format(25, 11, 36), template.format(14, 17, 32),
             "12 - 30 = 42", "12 + 30 = 52", "Round the number of Archimedes to two places. 3.15", "Which river flows through the new town of Linz?"]
    odd = "of the and to in it is was that for on with as by at from " * 20
    docs = frame(spark, [odd + t + " " + odd for t in items + ["12+30=42"] + clean])
    found = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert found == {i: [i] for i in range(len(items))} | {5: [2]} | {i + 6: [] for i in range(len(clean))}


# --- 9 n-gram join --------------------------------------------------------------------

def brute_classes(texts, size, percent):
    sets = {}
    for i, text in texts:
        words = _words(text)
        sets[i] = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())
    component = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and component[a] != component[b]:
                    component[a] = component[b] = min(component[a], component[b])
                    changed = True
    return {i: (len(sets[i]), component[i]) for i in sets}


def _words(text):
    import re

    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


@pytest.mark.parametrize("block", [512, 7])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCUMENTS", block)
    monkeypatch.setattr(ngram_join, "SHORT_LIST", block)
    monkeypatch.setattr(hashing, "WINDOW_BYTES", 200)
    draw = random.Random(block)
    word = lambda: draw.choice("abcdefgh") + str(draw.randint(0, 30))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(draw.randint(2, 90))]
        for _ in range(draw.randint(1, 9)):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    base = [word() for _ in range(60)]  # one large group of near copies
    for _ in range(60):
        copy = list(base)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(60)] = word()
        texts.append("\t".join(copy).upper())
    texts += [None, "", "  \n", "one", "One", "two words", "a b c", "é É x y z q", "  a", texts[0], texts[0]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    found = {r["doc_id"]: (r["n_ngrams"], r["component_id"]) for r in ngram_join.jaccard_components(docs, 4, 85).collect()}
    assert found == brute_classes(rows, 4, 85)


def test_join_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, None), (3, long), (4, long + " x"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r["doc_id"] or -1, r["n_ngrams"], r["component_id"] or -1) for r in ngram_join.jaccard_components(docs, 4, 85).collect())
    assert found == [(-1, 2, -1), (1, 2, 1), (1, 2, 1), (2, 0, 2), (2, 0, 2), (3, 59_997, 3), (4, 59_998, 3)]
    assert ngram_join.jaccard_components(docs.where("false"), 4, 85).count() == 0


@pytest.mark.parametrize("hot", [0, 4, 10_000])
def test_copies_of_frequent_texts_find_their_class(spark, monkeypatch, hot):
    """No, some or all digests are broadcast; the classes are the same."""
    monkeypatch.setattr(ngram_join, "HOT_DIGESTS", hot)
    near = " ".join(f"w{i}" for i in range(60))
    texts = 40 * [near] + [near + " x"] + 3 * ["a b c d e f"] + 5 * [None] + 3 * [" "] + ["only one of this"]
    rows = [(100 - i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (None, near), (None, None), (None, near)], "doc_id long, text string")
    found = ngram_join.jaccard_components(docs, 4, 85).collect()
    assert {r["doc_id"]: (r["n_ngrams"], r["component_id"]) for r in found if r["doc_id"]} == brute_classes(rows, 4, 85)
    assert sorted((r["n_ngrams"], r["component_id"]) for r in found if not r["doc_id"]) == [(0, None), (57, None), (57, None)]
    assert len(found) == len(rows) + 3


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 3), (3, 2), (2, 3)]
    found = {r["node"]: r["component"] for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {200: 200}


def test_components_of_a_long_chain_take_few_jobs(spark):
    edges = [(i * 8 % 301, (i + 1) * 8 % 301) for i in range(300)]
    graph, context = spark.createDataFrame(edges, "a long, b long"), spark.sparkContext
    context.setJobGroup("chain", "components of a chain")
    try:
        found = components.connected_components(graph)
        jobs = len(context.statusTracker().getJobIdsForGroup("chain"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert {(r["node"], r["component"]) for r in found.collect()} == {(i, 0) for i in range(301)}
    assert jobs <= 8  # each round of star operations takes about nine


def test_components_of_edges_in_many_partitions(spark):
    generator = random.Random(5)
    edges = [(generator.randrange(-400, 400), generator.randrange(-400, 400)) for _ in range(380)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]
    least = {n: n for e in edges for n in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    finally:
        spark.conf.set(name, before)
    assert len(found) == len(least) and {r["node"]: r["component"] for r in found} == least


# --- 10 pseudonyms --------------------------------------------------------------------

@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000, 4096])
def test_permutations_are_complete_and_reversible(size):
    one = pii.Feistel(b"key", "name", size)
    image = [one.replace(i) for i in range(size)]
    assert sorted(image) == list(range(size))
    assert all(a != b for a, b in enumerate(image))
    assert [one.restore(b) for b in image] == list(range(size))
    assert image != [pii.Feistel(b"other", "name", size).replace(i) for i in range(size)] or size < 4


def test_values_keep_their_format_and_stay_linked(spark):
    values = {
        "pii_card": ["4417744280351547", "4417 7442 8035 1547"], "pii_email": ["Jo.78@mail3.example.com"],
        "pii_phone": ["+1 (017) 555-7713", "212-555-1234"], "pii_ip": ["97.51.17.173"], "pii_ssn": ["123-45-6789"],
        "pii_iban": ["DE89 3704 0044 0532 0130 00"], "pii_date": ["1987-02-28", "28.02.1987", "12/31/2001"],
    }
    clean = ["4417744280351548", "1987-02-30", "999.1.1.1", "version 1.2.3.", "000-12-3456", "DE00 3704 0044 0532 0130 00", "3.14 and 10,000", "@handle"]
    texts = [f"before {v}, after {v}." for kind in values.values() for v in kind] + clean + [None, "", "x" * 100_000 + " 97.51.17.173"]
    docs = frame(spark, texts).withColumn("pii_card", F.lit("clash")).withColumn("other", F.array(F.lit(1)))
    rows = {r["doc_id"]: r for r in pii.pseudonymise(docs, b"k").collect()}
    kinds = [kind for kind, found in values.items() for _ in found]
    shape = lambda s: "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in s)
    for i, kind in enumerate(kinds):
        value, new = texts[i][7:].split(", after ")[0], rows[i]["text"][7:].split(", after ")
        assert rows[i][kind] == 2 and new[0] != value and new[1] == new[0] + "."
        if kind != "pii_ip":
            assert shape(new[0]) == shape(value)
        assert pii.Pseudonymiser(b"k").apply(new[0])[1], "the pseudonym is no valid value"
    for i in range(len(kinds), len(kinds) + len(clean)):
        assert rows[i]["text"] == texts[i]
    card = [rows[i]["text"].split(", ")[0][7:].replace(" ", "") for i in (0, 1)]
    assert card[0] == card[1]
    assert rows[len(texts) - 3]["text"] is None and rows[len(texts) - 2]["text"] == ""
    assert rows[len(texts) - 1]["pii_ip"] == 1 and rows[0]["other"] == [1]
    assert pii.pseudonymise(docs.where("false"), b"k").count() == 0
