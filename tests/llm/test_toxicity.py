"""Toxicity: folding, matching against plain search, learned terms, held-out documents."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES
from millrace.llm.toxicity import Model, fold

STEMS = ["blorg", "snarfle", "quent"]


def test_look_alikes_digits_and_marks_fold_into_one_word():
    want = fold("idiot clown scum")
    for text in ("1d10t c1own scum", "Іdіоt ｃlown $cum", "ídìöt CLOWN s¢um".replace("¢", "c"), "ídiot, cl0wn. 5cum"):
        assert fold(text) == want
    assert fold("100 $$$ 3.5") == "" and fold("") == "" and fold("x\ny") == " x y "


def plain_hits(model, folded):
    words, out = folded.split(), []
    inside = set()
    for phrase in model.exceptions:
        size = len(phrase.split())
        for at in range(len(words) - size + 1):
            if words[at : at + size] == phrase.split():
                inside.update(range(at, at + size))
    for at, word in enumerate(words):
        found = [w for entry, w in model.weights.items() if word.startswith(entry)]
        if found and at not in inside:
            out.append(max(found))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_automaton_finds_what_plain_search_finds(seed):
    draw = random.Random(seed)
    make = lambda: "".join(draw.choice("abc") for _ in range(draw.randint(1, 4)))
    words = [make() for _ in range(400)]
    model = Model({make(): draw.random() for _ in range(6)}, tuple({f"{draw.choice(words)} {draw.choice(words)}" for _ in range(8)}))
    folded = fold(" ".join(words))
    assert [w for *_, w in model.hits(folded)] == plain_hits(model, folded)


def test_slices_change_nothing(monkeypatch):
    model = Model({fold("blorg").strip(): 2.0}, (fold("blorg fish").strip(),))
    text = "word blorg, blorgish and more of it " * 200
    want = model.measure(text)
    monkeypatch.setattr(toxicity, "SLICE", 50)
    assert model.measure(text) == want == (800.0, 1400)


def corpus(seed, n=600):
    """A fifth of the documents hold bad words with endings, some disguised; `quent leaf` is harmless."""
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "ta me ro sil vun".split() for b in "ka lo pim der nu".split()]
    docs, labels = [], []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(5, 80))]
        bad = i % 5 == 1
        for _ in range(1 + len(words) // 25 if bad else 0):
            word = draw.choice(STEMS) + draw.choice(["", "s", "ing", "ed"])
            if draw.random() < 0.3:
                word = word.replace("o", "0").replace("a", "а").replace("e", "3")
            words.insert(draw.randrange(len(words)), word)
        if not bad and i % 7 == 0:
            words[2:2] = ["quent", "leaf"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def trained(spark, docs, labels, **options):
    return toxicity.train(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True), **options
    )


def test_lexicon_exceptions_and_held_out_scores(spark):
    docs, labels = corpus(1)
    model = trained(spark, docs, labels)
    assert {fold(s).strip() for s in STEMS} <= set(model.weights)
    assert fold("quent leaf").strip() in model.exceptions
    fresh, truth = corpus(2, 300)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(fresh, "doc_id long, text string"), model).collect()}
    right = sum((found[i] >= 0.5) == bool(t) for i, t in truth)
    assert right >= 295 and all(0 <= s <= 1 for s in found.values())


def test_more_of_it_scores_higher_and_length_normalises(spark):
    model = trained(spark, *corpus(3))
    one, two = model.score("blorg " + "taka " * 20), model.score("blorg blorg blorg " + "taka " * 20)
    assert two > one >= model.score("blorg " + "taka " * 20000) and model.score(None) == model.score("") < 0.5


def test_given_exceptions_count(spark):
    docs, labels = corpus(4)
    model = trained(spark, docs, labels, exceptions=["Blorg Day"])
    assert model.measure("the blorg day")[0] == 0 < model.measure("the blorg")[0]


def test_odd_documents(spark, odd_docs, no_docs):
    model = trained(spark, *corpus(5))
    clashing = odd_docs.withColumns({"score": F.lit("x"), "a.b": F.lit(1), "hits": F.lit(1)})
    found = toxicity.score(clashing, model)
    assert found.count() == 10 and sorted(found.columns) == sorted(clashing.columns)
    assert found.where("score < 0 or score > 1 or score is null").count() == 0
    assert toxicity.score(no_docs, model).count() == 0
    assert trained(spark, [], []) == Model() == trained(spark, [(1, "a")], [(1, 1)])
    assert Model().score("anything") == 0


def test_repeated_and_contradicting_labels(spark):
    docs, labels = corpus(6)
    again = trained(spark, docs + docs[:100], labels + [(i, 0) for i, _ in labels[:50]] + [(3, None), (None, 1)])
    once = trained(spark, docs, labels)
    assert again.weights == once.weights and again.power == pytest.approx(once.power)


def test_query_on_the_given_tables(spark):
    """Every document once, and most held-out labels met."""
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op11_toxicity"](spark, sf).cache()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found.select("doc_id").subtract(docs.select("doc_id")).count() == 0 and found.count() == docs.count()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    met = found.join(labels, "doc_id").where("held_out").select((F.col("predicted") == F.col("toxic")).cast("int").alias("ok"))
    assert met.agg(F.avg("ok")).first()[0] > 0.9
