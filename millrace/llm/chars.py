"""Character classes and hashed runs of characters, for whole arrays of code points."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, types as T

from ..session import ship_package

SPACE, LETTER, DIGIT, OTHER = range(4)
_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """The class of every code point: white space, letter, number or other."""
    if not _classes:
        table = np.full(0x110000, OTHER, np.uint8)
        points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (DIGIT, r"\p{N}")):
            table[np.frombuffer("".join(regex.findall(pattern, points)).encode("utf-32-le"), np.uint32)] = kind
        _classes.append(table)
    return _classes[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values with their bits spread (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def few_rows(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of a column each, one value at least."""
    sizes = np.zeros(batch.num_rows, np.int64)
    if batch.num_rows:
        sizes[:] = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, np.cumsum(sizes)
    while start < batch.num_rows:
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def add_columns(
    docs: DataFrame,
    added: Sequence[T.StructField],
    compute: Callable[[dict[str, pa.Array]], list[pa.Array]],
    needs: Sequence[str],
    sliced: str,
) -> DataFrame:
    """`docs` with columns that `compute` makes of the columns it needs, a few rows at a time by the size of
    `sliced`. The caller's columns may have any names; one named like a result is replaced by it."""
    names, new = docs.columns, {f.name.lower() for f in added}
    kept = [i for i, name in enumerate(names) if name.lower() not in new]
    at = {name: names.index(name) for name in needs}
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    fields = [plain.schema.fields[i] for i in kept] + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(added)]
    inner = [f.name for f in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in few_rows(whole, f"c{at[sliced]}"):
                found = compute({name: batch.column(i) for name, i in at.items()})
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *found], names=inner)

    return plain.mapInArrow(work, T.StructType(fields)).toDF(*[names[i] for i in kept], *[f.name for f in added])


@contextmanager
def few_records(spark, most: int = 500):
    """Smaller Arrow batches for what is run inside, where a row may hold whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def prepared(spark, most: int = 1000) -> None:
    """What queries and pipelines need of a session, whose results are evaluated later: this package on
    the workers, and rows of whole texts handed to Python in smaller batches."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= most:
        spark.conf.set(name, str(most))
