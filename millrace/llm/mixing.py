"""Mixing sources to target weights by capped water-filling.

Every source has a weight and may be repeated up to `max_epochs` times. Sources whose share would
exceed that are clamped, and what they leave is dealt to the others in proportion to their weights,
until no source is above its bound. All targets are then `least(bound, weight * level)` for one level.

A source is taken in whole repetitions and one fractional repetition: its documents in a seeded order,
up to the missing amount. So every document is taken `floor` or `floor + 1` times, and a source's total
is within half a document of its target.

Defined results: null text has size 0 and is taken as 0; a null source is a source of its own; no rows
give no rows; rows that are equal in id and size may swap places, which leaves the rows of the result
the same; other columns are kept by `repeat_documents` and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.sequences import number_rows
from ..session import written

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_table(rows: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """One row per source: its size, bound, and weight. Weights go round the sources in the
    order of their names by code point, null last."""
    sizes = rows.groupBy("_null", "_source").agg(F.sum("_size").alias("_total"))
    ranked = number_rows(sizes, [], ["_null", "_source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    bound = (F.col("_total") * F.lit(max_epochs)).cast("double")
    return written(ranked.select("_null", "_source", "_total", bound.alias("_bound"), weight.alias("_weight")), "sources")


def water_level(sources: DataFrame, budget: float) -> float | None:
    """The level at which `least(bound, weight * level)` adds up to the budget; null where every
    source ends at its bound. One small aggregate per round; a round only adds clamped sources."""
    level, clamped = 0.0, -1
    while True:
        at_bound = F.col("_bound") <= F.col("_weight") * F.lit(level)
        sums = sources.agg(
            F.sum(F.when(at_bound, F.col("_bound")).otherwise(0.0)).alias("given"),
            F.sum(F.when(at_bound, 0.0).otherwise(F.col("_weight"))).alias("weight"),
            F.count_if(at_bound).alias("clamped"),
        ).first()
        if not sums["weight"]:
            return None
        if sums["clamped"] == clamped:
            return level
        clamped, level = sums["clamped"], (budget - sums["given"]) / sums["weight"]


def targets(rows: DataFrame, weights: Sequence[float], max_epochs: float = 3.0, share: float = 1.0) -> DataFrame:
    """Sources with `_target`; all together they get `share` of all sizes."""
    sources = source_table(rows, weights, max_epochs)
    total = sources.agg(F.sum("_total")).first()[0] or 0
    level = water_level(sources, total * share)
    filled = F.col("_bound") if level is None else F.least("_bound", F.col("_weight") * F.lit(level))
    return sources.withColumn("_target", filled)


def mix_plan(
    docs: DataFrame,
    ident: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: Sequence[float] = (5, 2, 1),
    max_epochs: float = 3.0,
    share: float = 1.0,
    seed: int = 7,
    text: str = "text",
    carry: Sequence[Column] = (),
) -> DataFrame:
    """How often each document is taken: `_id, _size, _total` (its source's size), `_target`, `_times`, and
    what `carry` names.

    The seeded order inside a source is that of a digest. Its first three hex digits cut a source
    into 4096 pieces, so no window holds more than a piece; running totals over pieces join them.
    """
    # Rows without an id are told by their text, so that they do not all stand at one place.
    named = F.coalesce(F.col(ident).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), named))
    narrow = docs.select(
        F.col(ident).alias("_id"),
        F.col(source).isNull().alias("_null"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        (word_count(F.col(text)) if size is None else size).alias("_size"),
        digest.alias("_order"),
        *carry,
    )
    rows = written(narrow.withColumn("_piece", F.substring("_order", 1, 3)), "mix")
    planned = targets(rows, weights, max_epochs, share)
    whole = F.when(F.col("_total") > 0, F.floor(F.col("_target") / F.col("_total"))).otherwise(0).cast("long")
    planned = planned.withColumn("_whole", whole).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_total"))
    pieces = rows.groupBy("_null", "_source", "_piece").agg(F.sum("_size").alias("_piece_size"))
    before = Window.partitionBy("_null", "_source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_earlier", F.coalesce(F.sum("_piece_size").over(before), F.lit(0)))
    pieces = pieces.join(planned, ["_null", "_source"]).drop("_piece_size", "_bound", "_weight")
    inside = Window.partitionBy("_null", "_source", "_piece").orderBy("_order", "_size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(pieces, ["_null", "_source", "_piece"])
    passed = F.col("_earlier") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    once_more = passed * 2 + F.col("_size") <= F.col("_rest") * 2
    return joined.withColumn("_times", F.col("_whole") + once_more.cast("long"))


def repeat_documents(docs: DataFrame, ident: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns it came with. The plan is
    made for the rows themselves, so rows that are equal are decided on one by one."""
    names = docs.columns
    of = {name: f"c{i}" for i, name in enumerate(names)}
    # Written, so that a row keeps its number.
    plain = docs.toDF(*of.values()).withColumn("_row", F.monotonically_increasing_id())
    plain = written(plain, "rows")
    plan = mix_plan(plain, of[ident], of[source], text=of[text], carry=[F.col("_row")], **options)
    times = plan.where("_times > 0").select("_row", "_times")
    copies = plain.join(times, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return copies.select(*of.values()).toDF(*names)
