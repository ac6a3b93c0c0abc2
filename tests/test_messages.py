"""Extraction, conversion and checks of messages."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import convert, dates, jsonpath
from millrace.operators import extract, profile, quality
from millrace.spec import FieldSpec, SchemaSpec, SpecError

EDGE_FIELDS = (
    FieldSpec("$.from_key", "from_key", "STRING", True),
    FieldSpec("$.to_key", "to_key", "STRING", True),
    FieldSpec("$.reading.amount", "total", "LONG", True),
    FieldSpec("$.reading.share", "ratio", "DOUBLE", False),
    FieldSpec("$.object_key", "object_key", "STRING", True),
)
UPSERT = SchemaSpec(fields=EDGE_FIELDS, kind="edge", mode="UPSERT")
MIX = SchemaSpec(
    fields=(*EDGE_FIELDS, FieldSpec("$._operation", "_operation", "STRING", True)),
    kind="edge",
    mode="MIX",
    op_field="_operation",
)
LINK = {"from_key": "u17", "to_key": "shop", "object_key": "u17-shop", "reading": {"amount": "55.9", "share": 0.25}}


def link(drop=(), **more):
    """A good edge message without some members, and with others in their place."""
    message = {k: v for k, v in LINK.items() if k not in drop}
    return {**message, **more}


def reading(**members):
    return link(reading=members)


# One line for each rule of the checks: schema, message, code.
RULES = [
    (UPSERT, link(), None),
    (UPSERT, link(extra=[1, 2]), None),
    *[(UPSERT, link(drop=[key]), "CHECK_DIRTY_ERROR") for key in ("from_key", "to_key", "object_key")],
    *[(UPSERT, link(**{key: "  "}), "CHECK_DIRTY_ERROR") for key in ("from_key", "to_key", "object_key")],
    *[(UPSERT, link(**{key: "a/b"}), "CHECK_DIRTY_ERROR") for key in ("from_key", "to_key", "object_key")],
    (UPSERT, reading(share=0.5), "CHECK_DIRTY_ERROR"),
    (UPSERT, reading(amount=7), None),
    (UPSERT, reading(amount="seven", share=1), "TYPE_ERROR"),
    (UPSERT, reading(amount=7, share=" "), "TYPE_ERROR"),
    *[(MIX, link(_operation=op), None) for op in ("upsert", "Delete", "ADD", "update")],
    (MIX, link(), "CHECK_DIRTY_ERROR"),
    (MIX, link(_operation="insert"), "CHECK_DIRTY_ERROR"),
]


@pytest.mark.parametrize("schema,message,code", RULES)
def test_rules_of_the_checks(rows, schema, message, code):
    row = quality.validate(rows("value string", (json.dumps(message),)), schema).first()
    assert (row["error"] and row["error"]["code"]) == code
    if code is None:
        assert row["record"]["total"] == int(float(message["reading"]["amount"]))
        assert row["record"]["ratio"] == message["reading"].get("share")
        assert set(row["record"].asDict()) == {f.target for f in schema.fields}


def codes(rows, schema, *texts):
    data = rows("id int, value string", *enumerate(texts))
    found = quality.validate(data, schema, keep=["id"]).orderBy("id").collect()
    return [(r["error"]["code"] if r["error"] else None) for r in found]


def test_malformed_messages(rows):
    texts = ["", None, "[1]", '{"a"', "7", json.dumps(LINK)]
    assert codes(rows, UPSERT, *texts) == ["PARSE_ERROR"] * 5 + [None]


def test_wrong_parent_is_missing_not_malformed(rows):
    assert codes(rows, UPSERT, json.dumps({**LINK, "reading": 5})) == ["CHECK_DIRTY_ERROR"]


def test_first_error_wins_and_keys_are_texts(rows):
    data = rows("value string", (json.dumps({**LINK, "from_key": "　", "to_key": "a/b"}),))
    row = quality.validate(data, UPSERT).first()
    assert row["error"]["message"] == "from_key is missing or blank"
    data = rows("value string", (json.dumps({**LINK, "object_key": 5}),))
    assert quality.validate(data, UPSERT).first()["key"] == "5"


def test_empty_required_text_is_a_value_unless_told_otherwise(rows):
    fields = (FieldSpec("$.object_key", "object_key", "STRING", True), FieldSpec("$.n", "n", "STRING", True))
    text = '{"object_key":"1","n":""}'
    assert codes(rows, SchemaSpec(fields=fields), text) == [None]
    assert codes(rows, SchemaSpec(fields=fields, blank_is_null=True), text) == ["CHECK_DIRTY_ERROR"]


def test_indexed_quoted_nested_and_repeated_paths(rows):
    fields = [
        FieldSpec("$.arr[1].x", "x"),
        FieldSpec("$['a b']['c']", "c"),
        FieldSpec("$.store", "store", "OBJECT"),
        FieldSpec("$.store.price", "price", "DOUBLE"),
        FieldSpec("$.store.price", "again", "STRING"),
        FieldSpec("$.none.deep", "none"),
    ]
    text = '{"arr":[{"x":1},{"x":"two"}],"a b":{"c":true},"store":{"price":2.5}}'
    row = extract.extract(rows("value string", (text,)), fields).first()
    assert (row["x"], row["c"], row["price"], row["again"], row["none"]) == ("two", "true", "2.5", "2.5", None)
    assert json.loads(row["store"]) == {"price": 2.5}
    assert not row["malformed"]


@pytest.mark.parametrize("path", ["$..x", "$.a[*]", "$", "$.a[?(@.b)]", "$.a["])
def test_other_paths_are_refused(path):
    with pytest.raises(SpecError):
        jsonpath.steps(path)


def test_message_is_parsed_once(rows):
    checked = quality.validate(rows("value string", ("{}",)), MIX)
    for part in quality.split_clean_dirty(checked):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


LONGS = [
    ("12.9", 12), ("-12.9", -12), ("1e3", 1000), ("null", None), ("", None), ("true", None), (" 7 ", 7),
    ("9007199254740993", 9007199254740993), ("1e30", 9223372036854775807), ("-1e30", -9223372036854775808),
    ("NaN", 0), ("Infinity", 9223372036854775807), ("inf", None), ("nan", None),
]


def test_longs(rows):
    data = rows("i int, t string", *[(i, t) for i, (t, _) in enumerate(LONGS)])
    got = [r[0] for r in data.orderBy("i").select(convert.to_long(F.col("t"))).collect()]
    assert got == [v for _, v in LONGS]


def test_doubles_and_booleans(rows):
    texts = ["1d", " 12 ", "abc", "inf", "Infinity", "1e999", "TRUE", "yes", ""]
    data = rows("i int, t string", *enumerate(texts)).orderBy("i")
    got = data.select(convert.to_double(F.col("t")).alias("d"), convert.to_boolean(F.col("t")).alias("b")).collect()
    assert [r["d"] for r in got] == [1.0, 12.0, None, None, float("inf"), float("inf"), None, None, None]
    assert [r["b"] for r in got] == [False] * 6 + [True, False, False]


def test_numbers(rows):
    texts = ["1", "1.0", "1e3", "1.5", "1e30", "12345678901234567", "x"]
    data = rows("i int, t string", *enumerate(texts)).orderBy("i")
    got = [tuple(r[0]) for r in data.select(convert.normalise_number(F.col("t"))).collect()]
    assert got == [(1, None), (1, None), (1000, None), (None, 1.5), (None, 1e30), (12345678901234567, None), (None, None)]


def test_clean_json_and_envelope(rows):
    data = rows("value string", (json.dumps(reading(amount="55.9")),), (json.dumps(link(drop=["to_key"])),))
    checked = quality.validate(data, UPSERT)
    (good,) = quality.clean_json(checked).collect()
    assert json.loads(good["value"]) == {"from_key": "u17", "to_key": "shop", "total": 55, "object_key": "u17-shop"}
    envelope = quality.error_envelope(checked, "t1", "ES,HIVE", "2024-01-01 00:00:00")
    assert tuple(envelope.columns) == quality.ENVELOPE_FIELDS
    (bad,) = quality.envelope_json(envelope).collect()
    bad = json.loads(bad["value"])
    assert (bad["id"], bad["object_key"], bad["error_type"]) == ("u17-shop_ES,HIVE", "u17-shop", "CHECK_DIRTY_ERROR")
    assert json.loads(bad["data_row"]) == link(drop=["to_key"])


def test_counts_and_limits(spark, rows):
    from pyspark.sql import Observation

    data = rows("value string", (json.dumps(LINK),), ("x",), ("y",)).repartition(2)
    seen = Observation("dq")
    quality.count_metrics(quality.validate(data, UPSERT), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"consumed": 3, "dirty": 2}
    tasks = quality.counts_by_task(quality.validate(data, UPSERT)).collect()
    assert (sum(r["consumed"] for r in tasks), sum(r["dirty"] for r in tasks)) == (3, 2)
    quality.fail_over(10, -1)
    quality.fail_over(10, 10)
    with pytest.raises(quality.DirtyLimitExceeded):
        quality.fail_over(11, 10)


def test_dates(rows):
    texts = ["2024-02-29", "20240229", "2024-02-29 01:02:03", "20240229010203", "2024-02-29T01:02:03Z",
             "2024-02-29T01:02:03+01:00", "hello", "", None, "2024-13-01"]
    data = rows("i int, t string", *enumerate(texts)).orderBy("i")
    got = [r[0] for r in data.select(dates.format_local(dates.parse_date(F.col("t")))).collect()]
    day, instant = "2024-02-29 00:00:00", "2024-02-29 01:02:03"
    assert got == [day, day, instant, instant, instant, None, None, None, None, None]


def test_type_guess(rows):
    texts = ["20240101", "2024-01-01 00:00:00", "123", "1,234.5", "12.5", "-3", "abc", " ", None]
    data = rows("i int, t string", *enumerate(texts)).orderBy("i")
    got = [r[0] for r in data.select(profile.guess_type(F.col("t"))).collect()]
    assert got == ["DATETIME", "DATETIME", "LONG", "DOUBLE", "DOUBLE", "STRING", "STRING", "STRING", "STRING"]
