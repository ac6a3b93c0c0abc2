"""Byte pairs, language, quality and main text."""

import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import bytepair, html_text, langid, quality
from millrace.llm.queries import held_out

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = bytepair.read_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(seed, n):
    draw = random.Random(seed)
    parts = ["a", "b", "'", "'s", "'re", "'ve", "x'", " ", "  ", "\n", "\t", "1", "²", "é", "ß", "中文", "!", "--", "😀", "\x85", "​", "٣", "don't"]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 50))) for _ in range(n)]


def test_pieces_are_those_of_the_pattern():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in odd_texts(1, 3000):
        assert bytepair.pieces(text) == pattern.findall(text)


def test_ids_are_those_of_the_library(spark, library):
    texts = odd_texts(2, 500) + ["a" * 3000, "ab" * 1500 + "é" * 900, " " * 4000 + "x", "=-" * 2000, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("decoded0", F.lit(1))
    encoded = bytepair.encode(docs, PATH, decoded="both")
    for r in bytepair.decode(encoded, PATH).collect():
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text)
        assert bytes(r["decoded"]) == bytes(r["both"]) == text.encode()
    given = spark.table("documents") if spark.catalog.tableExists("documents") else spark.read.parquet(f"{SF}/documents.parquet")
    for r in bytepair.encode(given.select("text"), PATH).collect():
        assert r["ids"] == library.encode_ordinary(r["text"])


def test_odd_documents_are_encoded(odd_docs, no_docs):
    got = bytepair.encode(odd_docs, PATH, decoded="decoded")
    assert got.columns[: len(odd_docs.columns)] == odd_docs.columns and got.count() == 10
    assert got.where(F.coalesce("text", F.lit("")).cast("binary") != F.col("decoded")).count() == 0
    assert bytepair.encode(no_docs, PATH).count() == 0
    sums = got.where("text is null").select(*[c.alias(n) for n, c in bytepair.digests(got).items()]).first()
    assert sums["n_tokens"] == 0 and sums["ids_sha256"] == sums["decoded_sha256"]


def test_language_on_documents_kept_back(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, ~held_out("doc_id"))
    found = langid.predict(docs, model).where(held_out("doc_id"))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.97 and 0 <= right[1] <= right[2] <= 1
    assert 0.05 <= model.temperature <= 20 and np.mean(model.weights == 0) > 0.01
    # Only the text counts, and neither order nor partitions of the rows matter.
    moved = docs.repartition(5).withColumn("source", F.lit("?"))
    again = langid.train(moved, ~held_out("doc_id"))
    assert again.temperature == model.temperature and np.allclose(again.weights, model.weights)


def test_language_learns_from_eligible_rows_only(spark):
    docs = spark.createDataFrame([(i, "wort" if i % 2 else "mot", "de" if i % 2 else "fr") for i in range(200)], "doc_id long, text string, lang string")
    spoiled = docs.withColumn("lang", F.when(held_out("doc_id"), "xx").otherwise(F.col("lang")))
    a, b = (langid.train(d, ~held_out("doc_id")) for d in (docs, spoiled))
    assert a.languages == b.languages == ["de", "fr"] and np.array_equal(a.weights, b.weights)


def test_language_of_odd_documents(odd_docs, no_docs):
    model = langid.train(odd_docs, F.lit(True))
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in langid.predict(odd_docs, model).collect()}
    assert all(v == ("und", 0.0) for (_, t), v in got.items() if not t or t.startswith("..."))
    assert all(v[0] in ("de", "en") for (_, t), v in got.items() if t and t[0].isalpha())
    empty = langid.train(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(odd_docs, empty).collect()} == {"und"}
    assert langid.predict(no_docs, model).count() == 0


def test_grams_of_slices_are_those_of_the_whole(monkeypatch):
    text = "Ein längerer Text, mit 3 Zahlen. " * 20
    whole = langid.counted(text)
    monkeypatch.setattr(langid, "SLICE", 37)
    cut = langid.counted(text)
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


def test_the_leader_leaves_weights_at_zero():
    draw = np.random.default_rng(3)
    leader = langid.Leader(50, 3, l1=0.5)
    for _ in range(300):
        label = int(draw.integers(3))
        leader.learn(np.array([label, 10 + int(draw.integers(40))]), np.array([1.0, 0.1]), label)
    w = leader.weights(slice(None))
    assert (w[:3].argmax(axis=1) == [0, 1, 2]).all() and np.mean(w[10:] == 0) > 0.3


def test_quality_on_documents_kept_back(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    back = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = quality.co_train(docs, labels.where(~back))
    assert model.given and sum(map(sum, model.given)) > 0
    found = quality.score(docs, model).join(labels.where(back), "doc_id")
    hit = found.agg(F.avg(((F.col("quality_score") >= 0.5).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert hit > 0.95


def test_every_round_hands_over_new_feature_rows(spark):
    """A hot group of copies, and a metadata view that sees nothing."""
    draw = random.Random(8)
    good = lambda: " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 9))) for _ in range(30))
    bad = lambda: "".join(draw.choice("#!9 ") for _ in range(150))
    texts = [make() for _ in range(400) for make in (good, bad)] + [good()] * 300
    docs = spark.createDataFrame([(i, t, "s", "en", 100) for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(500)], "doc_id long, quality int")
    model = quality.co_train(docs, labels, growth=20)
    assert [g[0] for g in model.given] == [40, 40, 40]


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 1), (6, 0), (3, 0), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality.co_train(odd_docs, labels)
    scored = quality.score(odd_docs, model)
    assert scored.columns[: len(odd_docs.columns)] == odd_docs.columns and scored.count() == 10
    assert scored.where("quality_score between 0 and 1").count() == 10
    same = scored.where("doc_id = 1").select("quality_score").distinct()
    assert same.count() == 1
    assert quality.co_train(no_docs, labels) is None and quality.co_train(odd_docs, labels.where("quality = 1")) is None
    assert quality.score(odd_docs, None).where("quality_score = 1").count() == 10


def test_views_exchange_only_what_they_are_certain_of():
    model = quality.Model(*[quality.Logistic() for _ in range(5)], given=[])
    draw = np.random.default_rng(4)
    x, y = draw.normal(size=(400, 3)), draw.integers(0, 2, 400).astype(float)
    x[:, 0] += 4 * y
    clear, blind = quality.Logistic().fit(x, y), quality.Logistic().fit(x[:, 1:], y)
    model.content, model.metadata = clear, blind
    model.content_odds, model.metadata_odds = quality.platt(clear.log_odds(x)[:, None], y), quality.platt(blind.log_odds(x[:, 1:])[:, None], y)
    first, second = model.views(x, x[:, 1:])
    assert (np.maximum(first, 1 - first) >= quality.CERTAIN).sum() > 100
    assert (np.maximum(second, 1 - second) >= quality.CERTAIN).sum() == 0


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{x:1}</style></head><body class="has-sidebar">
<header><div class="logo">Site name here</div></header><div id="cookie-banner">We use cookies, accept them now please</div>
<div class="nav"><a href=1>One</a> <a>Two</a></div><div id="content"><h1>Title &amp; more</h1>
<p>First  para of
text with <b>bo</b>ld and <a href="x>y">link</a> words enough.<!-- not this --><p>An open one<br>goes on
<div class="ad">Buy now cheap stuff today</div><ul><li>item one of the list<li>item two of it</ul>
<script>var a = "<p>no</p>";</script><form>Email <input></form><p>Last&nbsp;para &lt;tag&gt; is here &#233;.</div>
<div class="sidebar">related stories one two three four five six</div>
<div id="comments"><article><p>nice post with many words by a reader of the site</p></article></div>
<footer>copyright all rights reserved</footer></body>"""
TEXT = """Title & more
First para of text with bold and link words enough.
An open one goes on
item one of the list
item two of it
Last para <tag> is here é."""


def test_main_text_of_a_page_without_an_article_mark(spark):
    weights = html_text.learn(spark.read.parquet(f"{SF}/pages.parquet"))
    assert html_text.main_text(PAGE, weights) == TEXT
    assert html_text.main_text(PAGE, html_text.weights_of({})) == TEXT
    assert html_text.main_text(PAGE + "<p>" + "word " * 3, weights) == TEXT


def test_main_text_is_the_marked_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = html_text.extract(pages, html_text.learn(pages)).collect()
    for r in found:
        article = r["html"].split("<article>", 1)[1].split("</article>")[0]
        blocks = regex.split(r"</?(?:p|h1)>", article)
        plain = (" ".join(html_text.html.unescape(regex.sub("<[^>]*>", " ", b)).split()) for b in blocks)
        assert r["text"] == "\n".join(b for b in plain if b)


@pytest.mark.parametrize(
    "start",
    ('article class="post has-sidebar"', 'main class="content with-sidebar"', 'article class="post category-legal"',
     'article class="comments-open"', 'div class="entry no-comments"', 'div itemprop="articleBody" class="no-comments"'),
)
def test_parts_of_class_names_do_not_lose_an_article(start):
    page = f"<body><{start}><p>one two three four five</p></{start.split()[0]}></body>"
    assert html_text.main_text(page, html_text.weights_of({})) == "one two three four five"
    assert html_text.purpose("article", ' class="post comments"') == "comments"
    assert html_text.purpose("div", ' class="main-menu"') == "menu"


def test_best_run_is_that_of_brute_force():
    draw = random.Random(6)
    weights = {"text p": 1.0, "text menu": -2.0, "tag p": -0.5, "tag nav": -1.0}
    for _ in range(60):
        page = "".join(draw.choice(["<p>one two</p>", "<nav>a b c</nav>", "<p>x</p>", "<nav>d</nav>"]) for _ in range(8))
        found = list(html_text.tokens(page))
        values = [
            weights.get(f"{t[0]} {t[1]}", 0.0) * (len(t[4].split()) if t[0] == "text" else 1) if t[0] != "space" else 0.0 for t in found
        ]
        best = max(sum(values[i:j]) for i in range(len(values)) for j in range(i, len(values) + 1))
        text = html_text.main_text(page, weights)
        assert bool(text) == (best > 0)


def test_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "<"), (4, "plain words only"), (5, "<p>" + "long words " * 50_000), (6, "<p>cut <b"), (4, "plain words only")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("tag", F.lit("x"))
    weights = html_text.learn(pages)
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages, weights).collect()}
    assert got[1] == got[2] == "" and got[4] == "plain words only" and got[6] == "cut" and len(got[5]) == 549_999
    assert html_text.extract(pages.limit(0), weights).count() == 0
