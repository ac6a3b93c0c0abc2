"""Changes applied to tables, against a plain replay."""

import random

from pyspark.sql import functions as F

from millrace.operators import changes
from millrace.sources.keyed import KeyedTable
from millrace.session import scratch_path
from millrace.spec import FieldSpec, SchemaSpec

OPS = ["ADD", "UPDATE", "UPSERT", "DELETE"]


def make_log(n, seed, hot=0.4):
    """A third and more of the changes go to one key."""
    draw = random.Random(seed)
    log = []
    for seq in range(1, n + 1):
        key = 0 if draw.random() < hot else draw.randrange(30)
        a = draw.choice([None, f"a{seq}"])
        b = draw.choice([None, seq])
        log.append((key, seq, draw.choice(OPS), a, b))
    return log


START = {k: (f"s{k}", -k) for k in range(0, 40, 2)}
SCHEMA = "k bigint, a string, b bigint"


def frames(rows, log):
    target = rows(SCHEMA, *[(k, *v) for k, v in START.items()])
    return target, rows("k bigint, seq bigint, op string, a string, b bigint", *log)


def replay_replace(log, state=None):
    state = dict(START if state is None else state)
    for k, _, op, a, b in log:
        if op == "DELETE":
            state.pop(k, None)
        else:
            state[k] = (a, b)
    return state


def replay_patch(log):
    state = dict(START)
    for k, _, op, a, b in log:
        if op == "DELETE":
            state.pop(k, None)
        else:
            old = state.get(k, (None, None))
            state[k] = (old[0] if a is None else a, old[1] if b is None else b)
    return state


def as_dict(df):
    got = df.collect()
    assert len({r["k"] for r in got}) == len(got)
    return {r["k"]: (r["a"], r["b"]) for r in got}


def gone():
    return F.col("op") == "DELETE"


def test_replace_in_sequence(rows):
    for seed in range(3):
        log = make_log(120, seed)
        target, frame = frames(rows, log)
        assert as_dict(changes.upsert_replace(target, frame, ["k"], "seq", gone())) == replay_replace(log)


def test_patch(rows):
    for seed in range(3):
        log = make_log(120, seed + 10)
        target, frame = frames(rows, log)
        assert as_dict(changes.upsert_patch(target, frame, ["k"], "seq", gone())) == replay_patch(log)


def test_delete_first(rows):
    log = make_log(60, 7, hot=0.1)
    target, frame = frames(rows, log)
    ordered = [c for c in log if c[2] == "DELETE"] + [c for c in log if c[2] != "DELETE"]
    got = changes.apply_batch(target, frame, ["k"], "seq", gone(), order="delete_first")
    assert as_dict(got) == replay_replace(ordered)


def test_delete_of_unknown_keys(rows):
    target, _ = frames(rows, make_log(1, 1))
    left = changes.delete_by_key(target, rows("k bigint", (0,), (999,)), ["k"])
    assert as_dict(left) == {k: v for k, v in START.items() if k != 0}


def test_classification(rows):
    fields = (FieldSpec("$.object_key", "object_key"), FieldSpec("$.op", "op"))
    data = rows("object_key string, op string", ("1", "delete"), ("2", "add"), ("3", None))
    mix = changes.classify_op(data, SchemaSpec(fields=fields, mode="MIX", op_field="op"))
    assert mix.columns == ["object_key", "is_delete"]
    assert [r["is_delete"] for r in mix.orderBy("object_key").collect()] == [True, False, False]
    for mode, flag in (("DELETE", True), ("UPSERT", False)):
        found = changes.classify_op(data, SchemaSpec(fields=fields, mode=mode)).collect()
        assert {r["is_delete"] for r in found} == {flag}


def test_changes_are_thinned_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS k", "id AS seq", "id AS b", "'x' AS a", "'ADD' AS op")
    plan = changes.latest_per_key(frame, ["k"], "seq")._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max_by" in plan


CHANGE = "k bigint, seq bigint, op string, a string, b bigint"


def test_a_small_batch_leaves_stored_rows_where_they_are(spark, rows, tmp_path):
    spark.range(200_000).selectExpr("id AS k", "'x' AS a", "id AS b").write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    rows(CHANGE, (2, 1, "ADD", "n", 1)).write.parquet(f"{tmp_path}/c")
    few = spark.read.parquet(f"{tmp_path}/c")
    for merged in (changes.apply_batch(target, few, ["k"], "seq", gone()), changes.upsert_patch(target, few, ["k"], "seq", gone())):
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "FullOuter" not in plan and "BroadcastHashJoin" in plan
        stored = next(part for part in plan.split("+- ") if "LeftAnti" in part)
        assert "BroadcastHashJoin" in stored
        assert merged.count() == 200_000


def keyed(spark, rows, path=None, **options):
    target, _ = frames(rows, make_log(1, 1))
    table = KeyedTable(spark, path or scratch_path(spark, "keyed"), target.schema, ["k"], **options)
    return table, target.withColumn("seq", F.lit(0))


def test_keyed_table_batches_replays_and_folds(spark, rows):
    for patch, replay in ((False, replay_replace), (True, replay_patch)):
        log = make_log(150, 21)
        table, start = keyed(spark, rows, buckets=4, patch=patch)
        assert table.read().count() == 0 and not table.fold()
        table.apply(start, "seq", 0)
        for number, at in enumerate(range(0, 150, 50), start=1):
            part = rows(CHANGE, *log[at : at + 50])
            assert table.apply(part, "seq", number, gone())
            assert not table.apply(part, "seq", number, gone())
            if number == 2:
                assert table.fold()
                assert not table.apply(part, "seq", number, gone())
        assert as_dict(table.read()) == replay(log)
        assert table.fold() and not table.fold()
        assert as_dict(table.read()) == replay(log)
        table.vacuum(keep_seconds=-5)
        assert len(table.versions()) == 1 and not table._change_sets() and as_dict(table.read()) == replay(log)


def test_a_new_job_begins_at_batch_0_again(spark, rows):
    table, start = keyed(spark, rows)
    table.apply(start, "seq", 7, job="first")
    table.fold()
    assert table.apply(rows(CHANGE, (999, 1, "ADD", "n", 1)), "seq", 0, gone(), job="second")
    assert not table.apply(rows(CHANGE, (999, 1, "ADD", "n", 1)), "seq", 7, gone(), job="first")
    assert as_dict(table.read()) == {**START, 999: ("n", 1)}


def test_the_stored_number_of_buckets_counts(spark, rows):
    table, start = keyed(spark, rows, buckets=4)
    table.apply(start, "seq", 0)
    table.fold()
    again, _ = keyed(spark, rows, table.path, buckets=16)
    again.apply(rows(CHANGE, *[(k, 1, "ADD", "n", 1) for k in range(10)]), "seq", 1, gone())
    again.fold()
    assert as_dict(again.read()) == {**START, **{k: ("n", 1) for k in range(10)}}


def test_a_batch_writes_as_much_as_it_holds(spark, rows):
    table, start = keyed(spark, rows, buckets=16)
    table.apply(start, "seq", 0)
    table.fold()
    table.apply(rows(CHANGE, (2, 1, "ADD", "n", 1)), "seq", 1, gone())
    assert spark.read.parquet(table._folder(2, "", 1)).count() == 1
    table.fold()
    assert [b for b, v in table._state()[0].items() if v == 2] and sum(v == 2 for v in table._state()[0].values()) == 1
    assert as_dict(table.read()) == {**START, 2: ("n", 1)}


def test_keyed_table_ignores_what_is_not_published(spark, rows):
    table, start = keyed(spark, rows, buckets=2)
    table.apply(start, "seq", 0)
    table.fold()
    start.limit(1).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{table.path}/data/v=2")
    start.limit(1).write.parquet(table._folder(2, "", 1))
    table.files.delete(f"{table._folder(2, '', 1)}/_SUCCESS")
    assert as_dict(table.read()) == START
    assert table.apply(rows(CHANGE, (2, 1, "ADD", "n", 1)), "seq", 1, gone()) and table.fold()
    assert as_dict(table.read()) == {**START, 2: ("n", 1)}
