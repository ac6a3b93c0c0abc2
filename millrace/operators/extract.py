"""Declared fields out of JSON messages, the text parsed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import convert, jsonpath
from ..spec import FieldSpec

CORRUPT = "_corrupt"


def _shape(paths: set[tuple]) -> T.StructType:
    """The struct to parse: nested by path, every leaf a text."""
    tree: dict = {}
    for path in sorted(paths):
        node = tree
        for name in path[:-1]:
            node = node.setdefault(name, {})
        node.setdefault(path[-1], {})

    def struct(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(n, struct(sub) if sub else T.StringType()) for n, sub in node.items()]
        )

    return struct(tree)


def _anchors(paths: list[tuple]) -> list[tuple]:
    """The part of each path that the struct parse covers: up to the first index, and no
    deeper than another path's that ends above it. The rest is read from the part's text."""

    def names(path: tuple) -> tuple:
        indexes = [i for i, step in enumerate(path) if isinstance(step, int)]
        return path[: indexes[0]] if indexes else path

    ends = {names(p) for p in paths}
    covered = []
    for path in map(names, paths):
        shorter = [path[:n] for n in range(1, len(path)) if path[:n] in ends]
        covered.append(shorter[0] if shorter else path)
    return covered


def extract(
    df: DataFrame, fields: Sequence[FieldSpec], value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """One text column per declared field, named by its target; undeclared fields go.

    `raw` holds the message and `malformed` is true where it is no JSON object. A missing
    or null field, also under a missing or wrong parent, is null.
    """
    paths = [jsonpath.steps(f.source) for f in fields]
    anchors = _anchors(paths)
    schema = _shape({a for a in anchors if a}).add(CORRUPT, T.StringType())
    parsed = F.from_json(F.col("raw"), schema, {"columnNameOfCorruptRecord": CORRUPT})
    # A generated column, unlike a projected one, is not copied into the filters on what
    # comes of it, so that the text is parsed once per row.
    named = df.select(*keep, F.col(value).alias("raw"))
    rows = named.select("*", F.inline(F.array(F.struct(parsed.alias("_doc")))))
    doc, raw = F.col("_doc"), F.col("raw")

    def field_column(path: tuple, anchor: tuple) -> Column:
        if not anchor:
            return F.get_json_object(raw, jsonpath.render(path))
        c = doc
        for name in anchor:
            c = c.getField(name)
        rest = path[len(anchor):]
        return F.get_json_object(c, jsonpath.render(rest)) if rest else c

    no_object = F.try_parse_json(raw).isNull() | ~F.ltrim(raw).startswith("{")
    malformed = F.when(doc.isNull(), True).when(doc.getField(CORRUPT).isNotNull(), no_object).otherwise(False)
    return rows.select(
        *keep,
        "raw",
        malformed.alias("malformed"),
        *[field_column(p, a).alias(f.target) for f, p, a in zip(fields, paths, anchors)],
    )


def convert_fields(df: DataFrame, fields: Sequence[FieldSpec], keep: Sequence[str] = ()) -> DataFrame:
    """Extracted texts to their declared types; a text that does not fit becomes null."""
    return df.select(*keep, *[convert.convert(F.col(f.target), f.type).alias(f.target) for f in fields])


def explode_batch(df: DataFrame, batch: str, name: str = "value") -> DataFrame:
    """One row per element of a batch array, other columns repeated."""
    others = [c for c in df.columns if c != batch]
    return df.select(*others, F.explode(batch).alias(name))
