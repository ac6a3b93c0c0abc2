"""Pages, links, mixes, vectors and names that went wrong once, each against a plain version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from millrace.llm import bytepair, html_text, langid, mixing, neighbours, quality, toxicity, urls
from millrace.llm.queries import QUERIES
from millrace.session import written

WEIGHTS = html_text.weights_of({})


@pytest.mark.parametrize("page, want", [
    ('<body><article style="overflow:hidden"><p>one two three</p></article>', "one two three"),
    ("<body><article><h1 title='The hidden valley'>The head</h1><p>one two</p></article>", "The head\none two"),
    ('<body><article data-id="sidebar"><p>one two three</p></article>', "one two three"),
    ("<body><article><p>before <a href='/x?id=search'>linked words</a> after it</p></article>", "before linked words after it"),
    ("<body><article><p>one</p><p class='share-price'>two three</p><p id='search-results'>four</p></article>", "one\ntwo three\nfour"),
    ("<body><main><div class='comments-open'><p>one two three</p></div></main>", "one two three"),
    ("<body><article><p>one two three four five six seven eight</p><div class='ad'>buy now</div><p>one two three four five six seven eight</p></article>",
     "one two three four five six seven eight\none two three four five six seven eight"),
    ("<body><article><p>one two</p><p hidden>not seen</p><p aria-hidden='true'>nor this</p></article>", "one two"),
    ("<body><article><div/><p>one two three</p></div></article>", "one two three"),
    ("<body><article class='comments'><p>me too and more of it</p></article>", ""),
])
def test_ordinary_pages(page, want):
    assert html_text.main_text(page, WEIGHTS) == want


def test_labelled_pages_overrule_the_lists():
    counts = {"text sidebar": (5000, 10), "text content": (10, 5000)}
    weights = html_text.weights_of(counts)
    assert weights["text sidebar"] > 0 > weights["text content"]


def test_the_run_is_the_best_of_all():
    draw = np.random.default_rng(3)
    tags = ["p", "div", "nav", "span", "aside", "li"]
    for _ in range(60):
        page = "".join(f"<{t}>{' '.join(['w'] * draw.integers(0, 6))}</{t}>" for t in draw.choice(tags, 8))
        weights = {f"{kind} {t}": float(draw.normal()) - (kind == "tag") for kind in ("text", "tag") for t in [*tags, "menu", "sidebar", "body"]}
        found = list(html_text.tokens(page))
        value = lambda t: (
            weights.get(f"text {t[1]}", 1.0) * len(t[4].split()) if t[0] == "text" else 0.0 if t[0] == "space" else weights.get(f"tag {t[1]}", -0.5))
        scores = [value(t) for t in found]
        sums = {(i, j): sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)}
        best = max(sums.values(), default=0.0)
        spans = [s for s, v in sums.items() if v >= best - 1e-9] if best > 1e-9 else []

        def text(span):
            blocks = {}
            for s, t in list(zip(scores, found))[slice(*span)]:
                if t[0] == "text" and s > 0:
                    blocks.setdefault(t[3], []).append(t[4])
            return "\n".join(" ".join("".join(b).split()) for b in blocks.values() if "".join(b).strip())

        assert html_text.main_text(page, weights) in ({text(s) for s in spans} or {""})


@pytest.mark.parametrize("html, want", [
    ('<link rel="nofollow canonical" href="http://b.net/fr/q">', "http://b.net/fr/q"),
    ('<link href="../fr/q" rel=canonical>', "http://www.net/x/fr/q"),
    ("<link rel='canonical' href='../../../fr/./q?a=../b'>", "http://www.net/fr/q?a=../b"),
    ("<link rel='canonical' href='?page=2'>", "http://www.net/x/y/z.html?page=2"),
    ("<link rel='canonical' href='..'>", "http://www.net/x/"),
    ("<base href='/fr/'><link rel='canonical' href='q'>", "http://www.net/fr/q"),
    ("<base href='//b.net/fr/'><link rel='canonical' href='q'>", "http://b.net/fr/q"),
    ("<!-- <link rel='canonical' href='/fr/q'> -->", None),
    ("<link title='rel=canonical' rel='next' href='/fr/q'>", None),
    ("<link data-rel='canonical' href='/fr/q'>", None),
    ("<meta http-equiv='Refresh' content='0; URL=/fr/q'>", "http://www.net/fr/q"),
    ("<meta content=\"5;url='//B.net/fr/q'\" http-equiv=refresh>", "http://b.net/fr/q"),
    ("<link rel='canonical' href='mailto:x@y'>", None),
    ("<link rel='canonical' href='/a?b=1&amp;c=2'>", "http://www.net/a?b=1&c=2"),
    (None, None),
])
def test_links_of_a_page(spark, html, want):
    pages = spark.createDataFrame([("http://www.net/x/y/z.html?old#f", html)], "url string, html string")
    assert [r["b"] for r in urls.alias_edges(pages).collect()] == ([want] if want else [])


def test_blocks_reach_aliases_through_resolved_links(spark):
    data = [(1, "http://a.org/fr/x", '<link rel="nofollow canonical" href="http://b.net/fr/q">'),
            (2, "http://www.net/es2/p", "<link rel=canonical href='../fr/q'>"), (3, "http://a.org/other", "")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    rules = [urls.Rule("allow", "com"), urls.Rule("block", "net", "/fr/")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect()}
    assert got == {1: (None, "block"), 2: (None, "block"), 3: (None, "allow")}


def test_rows_without_an_id_are_mixed_one_by_one(spark):
    docs = spark.range(1000).selectExpr("CAST(NULL AS bigint) AS doc_id", "'one two three four five six seven eight nine ten' AS text",
                                        "CASE WHEN id < 300 THEN 'a' WHEN id < 600 THEN 'b' ELSE 'c' END AS source", "id AS `a.b`", "1 AS _row")
    plan = mixing.mix_plan(docs)
    targets = {r["_source"]: r["_target"] for r in plan.collect()}
    taken = {r["source"]: r["n"] * 10 for r in mixing.repeat_documents(docs).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert all(abs(taken[s] - t) <= 10 for s, t in targets.items())
    assert mixing.repeat_documents(docs).columns == docs.columns


def test_large_finite_vectors_take_part(spark):
    vectors = [(0, [1e200, 0.0]), (1, [1.0, 2.0]), (2, [3.0, -1.0]), (20, [1e-200, 1.0]), (3, [1e200, 1e200]), (4, [-1e200, 5.0]), (40, [1e180, -1e180])]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(rows, F.col("_id") % 20 == 0, 3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    with np.errstate(over="ignore", invalid="ignore"):
        for q, v in vectors:
            if q % 20:
                continue
            scores = [(i, float(np.float64(v[0]) * x[0] + np.float64(v[1]) * x[1])) for i, x in vectors if i != q]
            best = sorted([(-s, i) for i, s in scores if not math.isnan(s)])[:3]
            assert sorted(got[q]) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]


CLASHING = "quality_score lang_pred ids score decoded text_out a.b _place".split()


def test_clashing_and_dotted_names(spark, odd_docs):
    docs = odd_docs.withColumns({n: F.lit("x") for n in CLASHING})
    quoted = [f"`{c}`" for c in docs.columns]
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, 0), (7, 1)], "doc_id long, quality int")
    model = quality.co_train(docs, labels)
    for found, new in (
        (quality.score(docs, model), {"quality_score", "quality_score_content", "quality_score_metadata"}),
        (langid.predict(docs, langid.train(docs, F.lit(True))), {"lang_pred", "score"}),
        (bytepair.encode(docs, public_tokenizers.path(corpus_pipeline.RANKS), decoded="decoded"), {"ids", "decoded"}),
        (html_text.extract(docs, WEIGHTS, "text", "text_out"), {"text_out"}),
        (toxicity.score(docs, toxicity.Model()), {"score"}),
    ):
        assert found.count() == 10 and sorted(found.columns) == sorted({*docs.columns, *new})
        assert found.select(*[c for c in quoted if c.strip("`") not in new]).count() == 10
    for keep in (corpus_pipeline.keep_quality, corpus_pipeline.keep_language, corpus_pipeline.mix_sources):
        kept = written(keep(spark, docs, "/root/testdata/sf0.001"), "kept")
        assert kept.columns == docs.columns


def test_quality_query_with_a_clashing_table(spark, tmp_path):
    for name in ("documents", "labels"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        rows.withColumn("quality_score", F.lit(5)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert QUERIES["op5_quality"](spark, str(tmp_path)).count() == spark.read.parquet(f"{tmp_path}/documents.parquet").count()


def test_a_round_of_co_training_scores_once(spark, monkeypatch):
    calls, plain = [], quality._most_certain
    monkeypatch.setattr(quality, "_most_certain", lambda *a: calls.append(1) or plain(*a))
    seen = []
    frame = type(spark.range(1))
    arrow = frame.toArrow

    def told(self):
        plan = self._jdf.queryExecution().optimizedPlan().toString()
        seen.append(plan.count("MapInArrow"))
        return arrow(self)

    monkeypatch.setattr(frame, "toArrow", told)
    sf = "/root/testdata/sf0.001"
    quality.co_train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert calls and max(seen) == 1
