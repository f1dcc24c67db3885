"""Fill-in-the-middle, centroid clustering and main text: brute force, edge cases, odd pages."""

from __future__ import annotations

import hashlib
import random
import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlake.llm import centroid_search, fill_in_middle, main_text, queries

SF_DIR = "/root/testdata/sf0.001"


# --- 11 fill in the middle ------------------------------------------------------------

@pytest.mark.parametrize("units", [0, 1, 15, 16, 17, 255, 256, 257, 5000])
def test_every_rank_of_a_skip_list_equals_a_plain_sum(units):
    draw = np.random.default_rng(units)
    lengths = draw.integers(1, 9, units)
    lane = fill_in_middle.UnitSkipList(lengths)
    before = np.concatenate([[0], np.cumsum(lengths)])
    ranks = range(units + 1) if units < 300 else draw.integers(0, units + 1, 200).tolist() + [0, units]
    assert len(lane) == units
    assert all(lane.code_points(r) == before[r] for r in ranks)


def _plain_fim(doc_id, text, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:low], lines[low:high], lines[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_examples_of_odd_texts_equal_a_plain_cut(spark):
    texts = [None, "", "\n", "\n\n\n", "one line", "a\nb", "漢字\n🙂 x\n\nend", "x <S> y\nz", "<P\n>", "a\r\nb\x0bc\x85d e\n",
             "<\nP>\n<P", "long " * 100_000 + "\n" + "line\n" * 50_000, "\\Q<P\\E>\n$1\n"] * 3
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "a\nb\nc", "x", 1), (4, "one line", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fim_form string, fim_cut int")
    made = fill_in_middle.fill_in_middle(docs).withColumn(
        "again", fill_in_middle.restored(F.col("fim_output"), F.col("fim_form")))
    assert sorted(made.columns) == sorted([*docs.columns, "fim_units", "fim_prefix_chars", "fim_middle_chars",
                                           "fim_output", "again"])
    found = made.collect()
    assert len(found) == len(rows)
    for r in found:
        got = (r["fim_units"], r["fim_form"], r["fim_prefix_chars"], r["fim_middle_chars"], r["fim_output"])
        assert got == _plain_fim(r["doc_id"], r["text"])
        assert r["again"] == (r["text"] or "") and r["fim_cut"] == 1
    assert {r["fim_form"] for r in found} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(docs.where("false")).count() == 0


def test_rates_units_and_sentinels_are_parameters(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("ab cd ef").alias("text"))
    made = fill_in_middle.fill_in_middle(
        docs, seed=1, fim_percent=40, spm_percent=25, unit=r"\S+\s*", sentinels=("[pre]", "[suf]", "[mid]"))
    forms = {r["fim_form"]: r["count"] for r in made.groupBy("fim_form").count().collect()}
    assert 1100 < forms["plain"] < 1300 and 130 < forms["spm"] < 280
    assert made.select("fim_units").distinct().first()[0] == 3
    assert made.where("fim_prefix_chars NOT IN (0, 3, 6, 8)").isEmpty()
    marks = ("[pre]", "[suf]", "[mid]")
    assert made.where(fill_in_middle.restored(F.col("fim_output"), F.col("fim_form"), marks) != F.col("text")).isEmpty()
    for bad in (("<P>", "<P>", "<M>"), ("aa", "a", "b"), ("ab", "bc", "d"), ("", "b", "c")):
        with pytest.raises(ValueError):
            fill_in_middle.fill_in_middle(docs, sentinels=bad)


# --- 12 centroid clustering -----------------------------------------------------------

@pytest.mark.parametrize("scale", [3, 1000, centroid_search.component_limit(8)])
def test_search_equals_comparing_all_centroids(scale):
    draw = np.random.default_rng(scale)
    centroids = draw.integers(-scale, scale + 1, (60, 8))
    centroids[10], centroids[20] = centroids[5], -centroids[5]
    vectors = np.vstack([draw.integers(-scale, scale + 1, (500, 8)), centroids, np.full((2, 8), scale)])
    wanted = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    found, distance = centroid_search.CentroidSearch(centroids).nearest(vectors)
    assert (distance == wanted.min(axis=1)).all()
    assert (found == wanted.argmin(axis=1)).all()  # of equals the smaller number


def test_search_leaves_most_centroids_out():
    draw = np.random.default_rng(5)
    centroids = (draw.normal(size=(400, 16)) + draw.normal(scale=3, size=(400, 1))) * 1000
    search = centroid_search.CentroidSearch(centroids.astype(np.int64))
    search.nearest((centroids + draw.normal(scale=100, size=centroids.shape)).astype(np.int64))
    assert search.computed < 0.1 * 400 * 400


def _plain_clusters(rows, k, rounds, seed):
    """Whole-number Lloyd rounds over (id, components) with Python's own integers."""
    order = sorted(range(len(rows)), key=lambda i: (
        hashlib.sha256(f"{seed}:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), rows[i][1]))
    centroids = [rows[i][1] for i in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in rows]

    for _ in range(rounds):
        own = assign()
        for n in range(len(centroids)):
            members = [v for (_, v), (_, m) in zip(rows, own) if m == n]
            if members:
                centroids[n] = [sum(column) // len(members) for column in zip(*members)]
    return centroids, assign()


def test_clusters_of_odd_vectors_equal_plain_rounds(spark):
    draw = random.Random(4)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(7, rows[7][1]), (7, [0.5, 0.5, 0.5, 0.5]), (None, [0.1, -0.1, 0.0, 0.2])] + [(100 + i, [0.25] * 4) for i in range(9)]
    left_out = [(200, None), (201, []), (202, [1.0] * 3), (203, [1.0] * 5), (204, [1.0, None, 1.0, 1.0]),
                (205, [float("nan")] * 4), (206, [float("inf"), 0.0, 0.0, 0.0])]
    schema = "vec_id long, embedding array<double>, cluster string, vector int"
    vectors = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows + left_out + [(300, [1e7, 0.0, 0.0, 0.0])]], schema)
    found = centroid_search.cluster(vectors, k=5, rounds=6, dimension=4, scale=100, seed=9)
    whole = [(i, [int(np.floor(100 * x)) for x in v]) for i, v in rows]
    centroids, own = _plain_clusters(whole, 5, 6, 9)
    assert found.centroids.tolist() == centroids
    got = sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in found.assigned.collect()), key=str)
    wanted = [(i, n, d) for (i, _), (d, n) in zip(whole, own)] + [(300, None, None)]  # distances beyond 64 bits
    assert got == sorted(wanted, key=str)


def test_few_and_no_vectors(spark):
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    few = centroid_search.cluster(vectors, dimension=2)
    assert len(few.centroids) == 2 and {(r["vec_id"], r["cluster"], r["distance"]) for r in few.assigned.collect()} == {
        (1, 0, 0), (2, 0, 0)}
    none = centroid_search.cluster(vectors.where("false"), dimension=2)
    assert len(none.centroids) == 0 and none.assigned.count() == 0
    with pytest.raises(ValueError):
        centroid_search.cluster(vectors, k=centroid_search.MAX_CENTROID_VALUES, dimension=2)


# --- 13 main text ---------------------------------------------------------------------

class _Article(HTMLParser):
    """Text of the article element by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [[]]

    def handle_starttag(self, tag, attributes):
        self.inside |= tag == "article"
        if tag in main_text.BLOCK or tag == "br":
            self.blocks.append([])

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in main_text.BLOCK:
            self.blocks.append([])

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1].append(data)


def test_main_text_query_equals_the_articles(spark):
    sources = {r["page_id"]: (r["url"], r["html"]) for r in queries.table(spark, "/root/testdata/sf0.01", "pages").collect()}
    rows = queries.op13_main_text(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(sources)
    for r in rows:
        parser = _Article()
        parser.feed(sources[r["page_id"]][1])
        parser.close()
        blocks = (" ".join("".join(b).split()) for b in parser.blocks)
        assert r["text"] == " ".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"]) and r["url"] == sources[r["page_id"]][0]


PARAGRAPHS = [
    "The committee met on Tuesday, and after a long debate it agreed to publish the report in full.",
    "Several members, among them the chair, had asked for more time; the others would not wait.",
    "What follows is a summary of the findings, which run to more than two hundred pages.",
    "None of this, said the chair, should come as a surprise to anyone who followed the hearings.",
]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
WANTED = " ".join(PARAGRAPHS)
MENU = "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Contact us")) + "</ul>"
TALK = "".join(f"<p>I disagree, and so do all my friends, with point number {i} of this piece!</p>" for i in range(9))

PAGES = {
    "article": (f"<body>{MENU}<article>{BODY}</article><footer>All rights reserved, 2024.</footer>", WANTED),
    "boxes": (f'<div id="top">{MENU}</div><div class="content"><h2>Findings</h2>{BODY}</div><div id="bottom">Imprint</div>',
              "Findings " + WANTED),
    "role": (f'<div class="sidebar"><p>{PARAGRAPHS[0]}</p></div><div role="main">{BODY}</div>', WANTED),
    "comments": (f'<div class="post">{BODY}</div><section id="comments"><h3>Comments</h3>{TALK}</section>', WANTED),
    "comment articles": (f'<article>{BODY}</article><article class="comment">{TALK}</article>', WANTED),
    "notices": (f'<div class="cookie-notice">We use cookies, as everyone does, to improve this site.</div><main>{BODY}</main>'
                f'<form><p>Send us your view, please.</p><input name="x"><select><option>One, two</option></select></form>', WANTED),
    "page form": (f'<form id="aspnet"><div class="menu">{MENU}</div><div class="text">{BODY}</div></form>', WANTED),
    "menu class around": (f'<div class="page with-sidebar">{MENU}<div class="body">{BODY}</div></div>', WANTED),
    "menu in article": (f"<article>{MENU}{BODY}</article>", WANTED),
    "links in text": (f'<article>{BODY}<p><a href="/x">More on this, in detail</a></p></article>', WANTED + " More on this, in detail"),
    "hidden": (f'<article>{BODY}<p hidden>Not, at all, shown.</p><p style="display: none">Nor, this.</p></article>', WANTED),
    "inline advert": (f'<article>{BODY}<p>Kept, here.<span class="ad">Buy now, cheap.</span></p></article>', WANTED + " Kept, here."),
    "references": ("<article><p>Fish &amp chips &lt;b&gt; caf&eacute;&nbsp;&#x1F642;&#65; &unknown; &am</p></article>",
                   "Fish & chips <b> café \U0001F642A &unknown; &am"),
    "spaces": ("<article><p> a\n\tb <b>c</b>d<br>e<i>f</i> </p>g<pre>h\n i</pre></article>", "a b cd ef g h i"),
    "raw": ("<article><script>if (a < b) '</p>';</script><style>p{}</style><p>Seen.</p><!-- <p>no</p> --><textarea>x</textarea></article>",
            "Seen."),
    "broken": (f'<article><p><b>One, two.<p>Three <i>four</b> five.<div title="a>b">six</div></span></p>{BODY}', "One, two. Three four five. six " + WANTED),
    "items": ("<article><ul><li>One, first<li>Two<ul><li>Three</ul></ul><table><tr><td>a<td>b<tr><td>c</table><dl><dt>t<dd>d</dl></article>",
              "One, first Two Three a b c t d"),
    "cut": (f"<article>{BODY}</article><footer class=\"x", WANTED),
    "plain": ("Only text, without markup.", "Only text, without markup."),
    "nothing": ("<html><body><nav>Menu, here.</nav><script>x</script></body></html>", ""),
    "comment only": ("<!-- never closed <p>x</p>", ""),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_main_text_of_many_layouts(name):
    source, wanted = PAGES[name]
    assert main_text.main_text(source)[0] == wanted


def test_main_text_of_odd_rows(spark):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, PAGES["article"][0], "x", 1), (3, PAGES["article"][0], "x", 1),
            (None, PAGES["plain"][0], "x", 1), (5, "<p>" + "word, " * 300_000, "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, main_text int")
    found = main_text.extract(pages)
    assert found.columns == [*pages.columns, "text_blocks"]
    got = sorted(((r["page_id"] or 0, len(r["text"]), r["text_blocks"], r["main_text"]) for r in found.collect()))
    assert got == [(0, 26, 1, 1), (1, 0, 0, 1), (2, 0, 0, 1), (3, len(WANTED), 4, 1), (3, len(WANTED), 4, 1), (5, 1_799_999, 1, 1)]
    assert main_text.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("piece, times", [
    ("<div>", 50_000), ("<p><b>", 30_000), ("<a <a ", 50_000), ("<!--", 50_000), ("<ul><li>t", 20_000), ("</p>", 50_000),
    ("<", 100_000), ('a="', 50_000), ("<td><p>", 20_000), ("<script>", 50_000), ("&", 100_000), ("<span class=ad>", 20_000)])
def test_bad_markup_takes_no_long_time(piece, times):
    begin = time.monotonic()
    main_text.main_text("<p " + piece * times if piece == 'a="' else piece * times)
    assert time.monotonic() - begin < 20
