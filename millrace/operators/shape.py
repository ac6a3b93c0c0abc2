"""Good rows in the shapes that stores take: documents, graph elements, cells, bulk lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import cells
from ..functions.keys import LOGIC_PARTITIONS, row_key, run_of, stable_salt
from ..spec import FROM_KEY, OBJECT_KEY, TO_KEY

ROW_KEY = "_row_key"
SALTS = 64


def _default(df: DataFrame, name: str, source: str) -> DataFrame:
    """`name` taken from `source` where absent."""
    if source not in df.columns:
        return df
    value = F.coalesce(F.col(name), F.col(source)) if name in df.columns else F.col(source)
    return df.withColumn(name, value)


def to_document(df: DataFrame) -> DataFrame:
    """Documents get an `id`."""
    return _default(df, "id", OBJECT_KEY)


def to_graph(df: DataFrame, kind: str = "vertex") -> DataFrame:
    """Graph elements get a `_key`, edges also `_from` and `_to`."""
    df = _default(df, "_key", OBJECT_KEY)
    if kind == "edge":
        df = _default(_default(df, "_from", FROM_KEY), "_to", TO_KEY)
    return df


def with_row_key(df: DataFrame, key: str = OBJECT_KEY, n_logic: int = LOGIC_PARTITIONS) -> DataFrame:
    return df.withColumn(ROW_KEY, row_key(F.col(key), n_logic))


def rows_to_cells(df: DataFrame, types: Mapping[str, str], key: str = ROW_KEY) -> DataFrame:
    """One row per present value: `row_key, family, qualifier, value` with value bytes."""
    values = F.array(
        *[
            F.struct(F.lit(name).alias("qualifier"), cells.encode(F.col(name), declared).alias("value"))
            for name, declared in types.items()
        ]
    )
    found = df.select(F.col(key).alias("row_key"), F.lit(cells.CELL_FAMILY).alias("family"), F.inline(values))
    return found.where(F.col("value").isNotNull())


def cells_to_rows(found: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cells back to one typed row per row key. One cell per key and qualifier is expected."""
    picked = [
        F.max(F.when(F.col("qualifier") == name, F.col("value"))).alias(name) for name in types
    ]
    rows = found.groupBy("row_key").agg(*picked)
    return rows.select("row_key", *[cells.decode(F.col(n), t).alias(n) for n, t in types.items()])


def document_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    return F.to_json(F.struct(*(columns or df.columns)))


def bulk_lines(
    df: DataFrame,
    index: str,
    doc_type: str,
    delete: Column | None = None,
    key: str = OBJECT_KEY,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Requests of a bulk call: an index action and the document, or a delete action."""
    target = F.struct(
        F.lit(index).alias("_index"), F.lit(doc_type).alias("_type"), F.col(key).cast("string").alias("_id")
    )
    put = F.concat_ws("\n", F.to_json(F.struct(target.alias("index"))), document_json(df, columns))
    drop = F.to_json(F.struct(target.alias("delete")))
    line = put if delete is None else F.when(delete, drop).otherwise(put)
    return df.select(F.col(key).alias(key), line.alias("lines"))


def bulk_batches(
    df: DataFrame, keys: Sequence[str], n: int = 2000, salts: int = SALTS, salt: Column | None = None
) -> DataFrame:
    """Adds `salt` and `batch` so that no (salt, batch) has more than `n` rows.

    The keys name a row. Salts follow from them and their number is given, so a row's salt does not
    depend on the other rows; rows are numbered inside a salt. Give more salts for larger inputs.
    """
    salt = stable_salt(F.concat_ws("\x1f", *keys), salts) if salt is None else salt
    salted = df.withColumn("salt", salt)
    place = F.row_number().over(Window.partitionBy("salt").orderBy(*keys))
    return salted.withColumn("batch", run_of(place - 1, n))


def bulk_payload(batches: DataFrame, keys: Sequence[str], lines: str = "lines") -> DataFrame:
    """One text per batch, at most the batch size of requests in each."""
    ordered = F.array_sort(F.collect_list(F.struct(*keys, lines)))
    texts = F.transform(ordered, lambda r: r.getField(lines))
    return batches.groupBy("salt", "batch").agg(
        F.count(F.lit(1)).alias("requests"), F.concat(F.array_join(texts, "\n"), F.lit("\n")).alias("payload")
    )


def collect_batch(df: DataFrame, keys: Sequence[str], seq: str, value: str, n: int | None = None) -> DataFrame:
    """Buffered values per key, in sequence order. All of a key by default; with `n`, lists of at most
    `n` values, for which rows are numbered inside their key, so repeated `seq` do no harm."""
    if n is None:
        df = df.withColumn("buffer", F.lit(0).cast("bigint"))
    else:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(seq, value))
        df = df.withColumn("buffer", run_of((place - 1).cast("bigint"), n))
    pairs = F.array_sort(F.collect_list(F.struct(seq, value)))
    return df.groupBy(*keys, "buffer").agg(F.transform(pairs, lambda p: p.getField(value)).alias("rows"))


def text_lines(df: DataFrame, columns: Sequence[str], delimiter: str = ",", escape: str | None = None) -> DataFrame:
    """Delimited text, a null written as `null`. With `escape`, that character is put before a delimiter
    or itself inside a value, and line breaks become `\\n` and `\\r`, so that a record stays one line."""

    def written(name: str) -> Column:
        text = F.col(name).cast("string")
        if escape:
            for plain, safe in ((escape, escape * 2), (delimiter, escape + delimiter), ("\n", escape + "n"), ("\r", escape + "r")):
                text = F.replace(text, F.lit(plain), F.lit(safe))
        return F.coalesce(text, F.lit("null"))

    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.concat_ws(delimiter, *[written(c) for c in columns]).alias("value"))
