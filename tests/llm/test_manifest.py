"""The Merkle manifest against a plain tree."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from millrace.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, at string, `a.b` string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, **changed):
    out = ""
    for name in manifest.FIELDS:
        value = changed.get(name, row[name])
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return h(out)


def tree(nodes, fan=16):
    """The root, and for each leaf the digests before and after it on every level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(place):
            run = nodes[at // fan * fan : at // fan * fan + fan]
            paths[i].append(("".join(run[: at % fan]), "".join(run[at % fan + 1 :])))
        nodes = [h("".join(nodes[i : i + fan])) for i in range(0, len(nodes), fan)]
        place = [at // fan for at in place]
    return nodes[0], paths


def plain(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for s in sources}
    subs = {s: tree([leaf(r) for r in own[s]]) for s in sources}
    root, above = tree([subs[s][0] for s in sources])
    out = []
    for number, s in enumerate(sources):
        for row, path in zip(own[s], subs[s][1]):
            path = path + above[number]
            node = leaf(row)
            if row["doc_id"] is not None and crc32(str(row["doc_id"]).encode()) % 5 == 0 and row["text"] is not None:
                node = leaf(row, text="".join(c.lower() if c.isascii() else c for c in row["text"]))
            for before, after in path:
                node = h(before + node + after)
            proof = h("".join(b + a for b, a in path))
            out.append((row["doc_id"], s, leaf(row), subs[s][0], root, proof, node, node == root))
    return sorted(out, key=str)


def made(seed, sizes):
    draw = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for i in range(n):
            text = draw.choice([None, "", "Grün ÄB Cd", f"Text {draw.random()}", "lower only"])
            rows.append({"doc_id": None if draw.random() < 0.02 else draw.randrange(10**draw.randint(1, 9)), "source": source,
                         "lang": draw.choice(["en", None]), "n_chars": draw.choice([None, 5, -1]), "text": text})
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 700, "b": 256, "B": 16, "é": 1, None: 17, "": 3},
    {f"s{i}": i % 3 + 1 for i in range(40)},
    {"one": 1},
    {"one": 2},
    {None: 5},
])
def test_manifest_is_that_of_a_plain_tree(spark, sizes):
    rows = made(len(sizes), sizes)
    docs = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", "y", "z") for r in rows], SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = manifest.manifest(docs, tampered)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    found = manifest.manifest(odd_docs)
    assert found.count() == 10 and found.where("not verified").count() == 0
    assert found.select("root").distinct().count() == 1
    assert manifest.manifest(no_docs).count() == 0


def test_one_changed_row_changes_the_root(spark, odd_docs):
    first = manifest.manifest(odd_docs).first()["root"]
    other = odd_docs.withColumn("lang", F.when(F.col("doc_id") == 7, "en").otherwise(F.col("lang")))
    assert manifest.manifest(other).first()["root"] != first


def test_siblings_meet_by_computed_places(spark):
    """A level joins on the place, and rows of other runs stay out."""
    nodes = spark.range(40).selectExpr("true AS _named", "'s' AS _source", "id AS at", "cast(id AS string) AS node")
    got = {r["run"]: r["kids"] for r in manifest.next_level(nodes, 8).collect()}
    assert got == {i: "".join(str(j) for j in range(8 * i, 8 * i + 8)) for i in range(5)}
