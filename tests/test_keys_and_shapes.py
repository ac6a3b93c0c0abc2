"""Keys, regions, cells and bulk requests."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from millrace.functions import cells, keys
from millrace.operators import layout, shape


def java_hash(text):
    value = 0
    units = text.encode("utf-16-be")
    for at in range(0, len(units), 2):
        value = (value * 31 + int.from_bytes(units[at : at + 2])) & 0xFFFFFFFF
    return value - (1 << 32) if value >= 1 << 31 else value


TEXTS = ["hello", "polygenelubricants", "张三", "a\U0001f600b", "", "x" * 3000, "é|ü", "zz/9"]


def test_hash_matches_its_definition(rows):
    got = rows("t string", *[(t,) for t in TEXTS]).select("t", keys.string_hash(F.col("t")).alias("h")).collect()
    assert {r["t"]: r["h"] for r in got} == {t: java_hash(t) for t in TEXTS}


def test_row_keys(rows):
    got = rows("t string", ("hello",), ("polygenelubricants",), ("张三",))
    assert [r[0] for r in got.select(keys.row_key(F.col("t"))).collect()] == [
        "322#hello", "968#polygenelubricants", "889#张三",
    ]


def test_split_points():
    points = keys.split_points(1000, 16)
    assert (len(points), points[:3], points[-1]) == (15, ["061", "123", "185"], "929")
    assert keys.split_points(1000, 1) == []
    assert keys.split_points(10, 3) == ["002", "005"]
    with pytest.raises(ValueError):
        keys.split_points(0, 4)


def test_regions_agree_with_bounds(rows):
    texts = [f"k{i}" for i in range(300)]
    data = shape.with_row_key(rows("object_key string", *[(t,) for t in texts]))
    bounds = keys.split_points()
    for r in layout.assign_region(data).collect():
        assert r["region"] == sum(b <= r["_row_key"] for b in bounds)


def test_cell_bytes(rows):
    row = rows("l bigint, d double, s string", (-2, -1.5, "ü")).select(
        cells.encode(F.col("l"), "LONG").alias("l"),
        cells.encode(F.col("d"), "DOUBLE").alias("d"),
        cells.encode(F.col("s"), "STRING").alias("s"),
        cells.encode(F.timestamp_millis(F.lit(1234567890123)), "DATETIME").alias("t"),
    )
    got = row.first()
    assert bytes(got["l"]) == struct.pack(">q", -2)
    assert bytes(got["d"]) == struct.pack(">d", -1.5)
    assert bytes(got["s"]) == "ü".encode()
    assert bytes(got["t"]) == struct.pack(">q", 1234567890123)
    back = row.select(cells.decode(F.col("l"), "LONG"), cells.decode(F.col("d"), "DOUBLE")).first()
    assert tuple(back) == (-2, -1.5)


def test_absent_values_make_no_cells(rows):
    data = rows("_row_key string, a bigint, b string", ("1", None, "x"), ("2", 5, None))
    found = shape.rows_to_cells(data, {"a": "LONG", "b": "STRING"})
    assert {(r["row_key"], r["qualifier"]) for r in found.collect()} == {("1", "b"), ("2", "a")}


def test_bulk_payloads_are_whole_and_small(rows):
    data = rows("object_key string, n int", *[(f'k"{i}', i) for i in range(1000)])
    lines = shape.bulk_lines(data, "i", "t", F.col("n") % 10 == 0)
    batches = shape.bulk_payload(shape.bulk_batches(lines, ["object_key"], 64, salts=3), ["object_key"]).collect()
    assert sum(b["requests"] for b in batches) == 1000 and max(b["requests"] for b in batches) <= 64
    parsed = [json.loads(t) for b in batches for t in b["payload"].splitlines()]
    assert sum("delete" in p for p in parsed) == 100 and sum("index" in p for p in parsed) == 900
    assert {p["index"]["_id"] for p in parsed if "index" in p} == {f'k"{i}' for i in range(1000) if i % 10}


def test_graph_and_documents_keep_given_names(rows):
    data = rows("object_key string, from_key string, to_key string, _key string, id string", ("1", "a", "b", None, "z"))
    row = shape.to_document(shape.to_graph(data, "edge")).first()
    assert (row["_key"], row["_from"], row["_to"], row["id"]) == ("1", "a", "b", "z")


def test_salts_and_key_order(spark, rows):
    data = rows("object_key string", *[(f"k{i}",) for i in range(500)])
    sizes = layout.salt(data, 5).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 5 and sum(r["count"] for r in sizes) == 500
    spread = layout.spread_by_region(shape.with_row_key(data), 4)
    parts = [[r["_row_key"] for r in part] for part in spread.rdd.glom().collect()]
    flat = [k for part in parts for k in part]
    assert flat == sorted(flat)
