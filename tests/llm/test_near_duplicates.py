"""Order MinHash, banded alignment and groups, against plain versions; the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import neardup
from millrace.session import written


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def edited(words, edits, draw):
    out = list(words)
    for _ in range(edits):
        at, kind = draw.randrange(len(out) + 1), draw.random()
        if kind < 0.34 or not out:
            out.insert(at, draw.choice(VOCABULARY))
        elif kind < 0.67:
            out.pop(min(at, len(out) - 1))
        else:
            out[min(at, len(out) - 1)] = draw.choice(VOCABULARY)
    return out


VOCABULARY = [f"w{i}" for i in range(4000)]


def test_alignments_are_exact_within_their_band():
    draw = random.Random(1)
    pairs = []
    for _ in range(150):
        a = [draw.randint(1, 30) for _ in range(draw.randint(0, 50))]
        b = [x for x in a if draw.random() > 0.1] + [draw.randint(1, 30) for _ in range(draw.randint(0, 4))]
        pairs.append((np.array(a, np.uint32), np.array(b, np.uint32)))
    true = np.array([distance(a.tolist(), b.tolist()) for a, b in pairs])
    for band in (1, 4, 16, 64):
        found = neardup.banded_distance([a for a, _ in pairs], [b for _, b in pairs], band)
        assert (found >= true).all() and (found[true <= band] == true[true <= band]).all()
    longer = np.array([max(len(a), len(b), 1) for a, b in pairs])
    want = 1 - true / longer
    assert np.allclose(neardup.similar(pairs), np.where(want >= 0.8 - 1e-9, want, 0))


def test_sketches_agree_as_often_as_both_kmers_do():
    draw = random.Random(2)
    shares, agreed = [], []
    for _ in range(60):
        a = [draw.choice(VOCABULARY) for _ in range(200)]
        b = edited(a, 6, draw)
        x, y = (neardup.word_hashes(" ".join(w)) for w in (a, b))
        k, m = neardup.labelled_kmers(x, 5), neardup.labelled_kmers(y, 5)
        shares.append(len(np.intersect1d(k, m)) / len(np.union1d(k, m)))
        agreed.append(np.mean(neardup.sketch(x, 5) == neardup.sketch(y, 5)))
    assert abs(np.mean(agreed) - np.mean(np.square(shares))) < 0.06


def test_order_and_occurrence_count():
    words = neardup.word_hashes
    assert (words("Ein, WORT!") == words("ein wort")).all() and not len(words("... !"))
    forward, backward = "a b c d e f g h i j", "f g h i j a b c d e"
    assert (neardup.sketch(words(forward)) != neardup.sketch(words(backward))).any()
    repeated = neardup.labelled_kmers(words("x " * 20))
    assert len(set(repeated.tolist())) == 18
    once = neardup.labelled_kmers(words("a b c d e"), 5)
    assert np.isin(once, neardup.labelled_kmers(words("a b c d e a b c d e"), 5)).all()


def plain_groups(docs, least=0.8):
    """Groups by comparing every pair."""
    words = {i: neardup.word_hashes(t or "").tolist() for i, t in docs}
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, t) in enumerate(docs):
        for j, u in docs[:n]:
            same = t is not None and t == u
            a, b = words[i], words[j]
            if not same and a and b and abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)):
                same = 1 - distance(a, b) / max(len(a), len(b)) >= least
            if same:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in docs}


def planted(seed):
    """Families of near copies, documents that share a passage, and documents by themselves."""
    draw = random.Random(seed)
    passage = [draw.choice(VOCABULARY) for _ in range(40)]
    docs = []
    for _ in range(8):
        base = [draw.choice(VOCABULARY) for _ in range(draw.randint(30, 120))]
        docs += [" ".join(base)] * 2 + [" ".join(edited(base, len(base) // 25 + 1, draw)) for _ in range(4)]
    for _ in range(25):
        docs.append(" ".join(passage + [draw.choice(VOCABULARY) for _ in range(40)]))
    docs += ["only five words are here", "only five words are here", "Only five words, are here!", "tiny", None, "", "...", "..."]
    order = list(range(len(docs)))
    draw.shuffle(order)
    return [(n * 3, docs[i]) for n, i in enumerate(order)]


@pytest.mark.parametrize("seed", range(2))
def test_groups_are_those_of_all_pairs(spark, seed):
    docs = planted(seed)
    got = neardup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == plain_groups(docs)
    sizes = {}
    for r in got:
        sizes[r["class_id"]] = sizes.get(r["class_id"], 0) + 1
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got)


def test_groups_of_odd_documents(odd_docs, no_docs):
    rows = sorted(((r["doc_id"], r["class_id"]) for r in neardup.groups(odd_docs).collect()), key=str)
    assert len(rows) == 10
    assert [c for i, c in rows if i == 1] == [1, 1] and (2, 2) in rows and (3, 3) in rows and (4, 4) in rows
    assert sorted((c for i, c in rows if i is None), key=str) == [1, None]
    assert neardup.groups(no_docs).count() == 0
    kept = neardup.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, 7, None, None], key=str)
    assert neardup.one_of_each(no_docs).count() == 0


def test_a_hot_group_gives_one_pair_a_member(spark):
    draw = random.Random(3)
    base = [draw.choice(VOCABULARY) for _ in range(60)]
    docs = [(i, " ".join(edited(base, 1, draw))) for i in range(300)]
    rows = neardup.sketched(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    pairs = neardup.candidate_pairs(written(rows, "rows").select("_id", "_sketch", "_n"))
    assert pairs.count() <= 56 * 300
    assert neardup.groups(spark.createDataFrame(docs, "doc_id long, text string")).select("class_id").distinct().count() == 1


def test_all_pairs_of_a_bucket_are_linked_or_ruled_out(spark):
    """Near copies that share most of their words with unrelated documents, one of which heads their buckets."""
    draw = random.Random(4)
    passage = [draw.choice(VOCABULARY) for _ in range(75)]
    texts = [passage + [draw.choice(VOCABULARY) for _ in range(25)] for _ in range(40)]
    for _ in range(60):
        own = [draw.choice(VOCABULARY) for _ in range(25)]
        changed = set(draw.sample(range(25), 15))
        texts += [passage + own, passage + [draw.choice(VOCABULARY) if i in changed else w for i, w in enumerate(own)]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sketches = {r["_id"]: np.array(r["_sketch"]) for r in neardup.sketched(frame, "doc_id", "text").collect()}
    got = {r["doc_id"]: r["class_id"] for r in neardup.groups(frame).collect()}
    pairs = [(i, i + 1) for i in range(40, 160, 2) if (sketches[i] == sketches[i + 1]).any()]
    assert len(pairs) > 30 and all(1 - distance(texts[i], texts[j]) / 100 >= 0.8 for i, j in pairs)
    assert [(i, j) for i, j in pairs if got[i] != got[j]] == []
    assert all(got[i] == i for i in range(40))


@pytest.mark.parametrize("edits", (20, 18, 15))
def test_pairs_at_the_threshold_share_a_bucket(spark, edits):
    """Words substituted at random places of 100, for similarities of 0.80 to 0.85."""
    draw, docs = random.Random(6), []
    for n in range(200):
        base = [draw.choice(VOCABULARY) for _ in range(100)]
        changed = set(draw.sample(range(100), edits))
        copy = [draw.choice(VOCABULARY) if i in changed else w for i, w in enumerate(base)]
        docs += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(copy))]
    rows = neardup.sketched(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text").collect()
    sketches = {r["_id"]: np.array(r["_sketch"]) for r in rows}
    assert sum((sketches[i] == sketches[i + 1]).any() for i in range(0, 400, 2)) >= 0.96 * 200


def test_word_counts_rule_out_no_pair_that_could_count():
    draw = random.Random(5)
    words = [np.array([draw.randint(1, 600) for _ in range(draw.randint(1, 40))], np.uint32) for _ in range(60)]
    words += [np.r_[w[: len(w) // 2], w[len(w) // 2 + 1 :], np.uint32(7)] for w in words[:30]]
    bins = np.stack([neardup.counted(w) for w in words]).astype(np.int32)
    sizes, others = np.array([len(w) for w in words]), np.arange(len(words))
    passed = 0
    for i, a in enumerate(words):
        left, share = neardup.near(bins, sizes, i, others, 0.8)
        passed += len(left)
        for j, b in enumerate(words):
            far = distance(a.tolist(), b.tolist()) / max(len(a), len(b))
            assert far > 0.2 or j in left
            assert j not in left or share[left.tolist().index(j)] <= far + 1e-9
    assert passed < len(words) * 6


def named_pairs(spark, monkeypatch, docs):
    """How many pairs the rounds after the heads name, and the classes."""
    counts, plain = [], neardup.rest_pairs

    def counting(*args):
        found = written(plain(*args), "named")
        counts.append(found.count())
        return found

    monkeypatch.setattr(neardup, "rest_pairs", counting)
    classes = {r["doc_id"]: r["class_id"] for r in neardup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    monkeypatch.setattr(neardup, "rest_pairs", plain)
    return sum(counts), classes


def test_named_pairs_grow_with_the_members(spark, monkeypatch):
    """Copies of one text, each changed by itself so much that most are not similar to the head."""
    found = {}
    for n in (200, 800):
        draw = random.Random(8)
        base = [draw.choice(VOCABULARY) for _ in range(60)]
        docs = [(i, " ".join(draw.choice(VOCABULARY) if j in changed else w for j, w in enumerate(base)))
                for i in range(n) for changed in [set(draw.sample(range(60), 8))]]
        found[n], _ = named_pairs(spark, monkeypatch, docs)
    assert 0 < found[800] <= 6 * found[200]


def test_documents_that_share_a_passage_name_few_pairs(spark, monkeypatch):
    draw = random.Random(9)
    passage = [draw.choice(VOCABULARY) for _ in range(30)]
    docs = [(i, " ".join(passage + [f"w{draw.randrange(5000)}" for _ in range(60)])) for i in range(800)]
    pairs, classes = named_pairs(spark, monkeypatch, docs)
    assert pairs < 800 and all(i == c for i, c in classes.items())


def test_an_id_with_two_texts_keeps_the_links_of_both(spark):
    draw = random.Random(10)
    first, second = ([draw.choice(VOCABULARY) for _ in range(60)] for _ in range(2))
    docs = [(5, " ".join(first)), (5, " ".join(second)), (6, " ".join(edited(first, 2, draw))), (7, " ".join(edited(second, 2, draw))),
            (None, " ".join(edited(first, 3, draw)))]
    for rows in (docs, docs[::-1]):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        got = {(r["doc_id"], r["class_id"], r["class_size"], r["links"] > 0) for r in neardup.groups(frame).collect()}
        assert got == {(5, 5, 3, True), (5, 5, 2, True), (6, 5, 3, True), (7, 5, 2, True), (None, 5, 3, True)}
        kept = sorted((tuple(r) for r in neardup.one_of_each(frame).collect()), key=str)
        assert kept == sorted([docs[0], docs[1], docs[4]], key=str)


def test_one_of_each_with_maps_and_clashing_names(spark):
    docs = spark.sql("SELECT id AS doc_id, 'one two three' AS text, map('a', id) AS m, 1 AS `a.b`, 2 AS _kept_id, 3 AS c0 FROM range(4)")
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [0]


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, folder), "stage")
        sizes.append(docs.count())
        if name == "near duplicates":
            left = plain_groups([(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect() if len(r["text"]) < 2500])
            kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
            assert all(len([i for i, c in left.items() if c == root and i in kept]) <= 1 for root in set(left.values()))
        if name != "byte pair encoding":
            assert docs.columns == columns
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3] > 0 and sizes[4] == sizes[5]
    assert docs.where("not round_trip").count() == 0
    assert corpus_pipeline.run(spark, folder).count() == sizes[5]


def test_pipeline_stages_on_odd_documents(spark, odd_docs, no_docs):
    folder = "/root/testdata/sf0.001"
    for start in (odd_docs, no_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, folder), "stage")
            docs.count()
    assert written(corpus_pipeline.keep_language(spark, odd_docs, folder), "x").where("text is null").count() == 0


def test_counterdiagonals_give_the_distances_of_a_plain_table():
    draw = np.random.default_rng(7)
    pairs = []
    for _ in range(150):
        a = draw.integers(0, 12, draw.integers(0, 50)).astype(np.uint32)
        b = a[draw.random(len(a)) > 0.1]
        if draw.random() < 0.5:
            b = np.insert(b, draw.integers(0, len(b) + 1, 3), draw.integers(0, 12, 3)).astype(np.uint32)
        pairs.append((a, b) if draw.random() < 0.5 else (b, a))
    true = []
    for a, b in pairs:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a.tolist(), 1):
            new = [i]
            for j, y in enumerate(b.tolist(), 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        true.append(row[-1])
    true = np.array(true)
    for band in (2, 5, 16, 60):
        found = neardup.banded_distance([a for a, _ in pairs], [b for _, b in pairs], band)
        assert (found >= true).all() and (found[true <= band] == true[true <= band]).all()
    assert all(neardup.least_distance(a, b) <= d for (a, b), d in zip(pairs, true))
    longer = np.array([max(len(a), len(b)) for a, b in pairs])
    expected = np.where(longer > 0, 1 - true / np.maximum(longer, 1), 1.0)
    assert np.allclose(neardup.similar(pairs), np.where(expected >= 0.8 - 1e-12, expected, 0))
