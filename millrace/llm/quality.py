"""Document quality by co-training on two views.

The content view sees the text: hashed runs of character shapes and a few measures of words and lines.
The metadata view sees what is known about the page without reading it: source, language and the stated
length. Both are logistic regressions, first fitted on a bounded sample of labelled
documents. In every round each view scores all unlabelled documents; those of which it is most
certain are given to the other view as pseudo-labels, and both are fitted again. At the end both views
are calibrated on labelled documents kept back, combined by their log-odds, and score all documents.

A view that cannot tell the classes apart is never certain, so it hands over nothing, and its weight in
the combination is near 0. Nothing but the features (under 400 bytes a document) is kept between rounds.

Defined results: null text is scored like empty text, which has no content features; null metadata is
a value of its own; without labels of both classes every document is scored 1 and kept; a document
labelled twice counts with its larger label; ties in certainty go to the smaller id; documents with a
null id are scored but not learned from; repeated rows get one score; other columns are kept, but those named
like a result are replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import written
from .chars import DIGIT, LETTER, SPACE, add_columns, char_classes, code_points, few_rows

SHAPES, SLICE = 128, 1 << 20
SOURCES, LANGS, LENGTH = 32, 16, 4
FIT_ROWS = 6000  # labelled documents in the fit, about
ROUNDS, GROWTH, CERTAIN = 3, 200, 0.95


def shape_counts(points: np.ndarray) -> np.ndarray:
    """How often each hashed run of three character shapes occurs: a and A for letters by case, 0 for
    digits, blank and line break, other characters as themselves."""
    counts = np.zeros(SHAPES)
    for start in range(0, len(points), SLICE):
        part = points[max(0, start - 2) : start + SLICE]
        kind = char_classes()[part]
        shape = np.where(kind == LETTER, 97, np.where(kind == DIGIT, 48, part)).astype(np.uint64)
        shape[(kind == SPACE) & (part != 10)] = 32
        upper = (part >= 65) & (part <= 90) | (part >= 192) & (part <= 222)
        shape[upper] = 65
        if len(shape) > 2:
            run = (shape[:-2] * np.uint64(31) + shape[1:-1]) * np.uint64(31) + shape[2:]
            at = (run * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(57)).astype(np.int64)
            counts += np.bincount(at, minlength=SHAPES)[:SHAPES]
    return counts


def content_features(text: str | None) -> np.ndarray:
    text = text or ""
    points = code_points(text)
    n = max(1, len(points))
    shapes = shape_counts(points)
    kinds = np.bincount(char_classes()[points], minlength=4) / n
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    many = max(1, len(words))
    letters = max(1.0, kinds[LETTER] * n)
    upper = np.count_nonzero((points >= 65) & (points <= 90) | (points >= 192) & (points <= 222))
    measures = [
        *kinds,
        upper / letters,
        min(20.0, len(text) / many) / 20,
        len(set(words)) / many,
        len(set(lines)) / max(1, len(lines)),
        min(1.0, many / max(1, len(lines)) / 100),
        sum(not w[-1].isalnum() for w in words) / many,
        sum(not any(c.isalnum() for c in w) for w in words) / many,
        sum(a == b for a, b in zip(words, words[1:])) / many,
        np.log1p(len(words)) / 12,
    ]
    return np.r_[np.sqrt(shapes / max(1.0, shapes.sum())), measures].astype(np.float16)


def metadata_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """What is known about a page without its text."""
    out = np.zeros(SOURCES + LANGS + LENGTH, np.float16)
    out[zlib.crc32(f"{source is None}{source}".encode()) % SOURCES] = 1
    out[SOURCES + zlib.crc32(f"{lang is None}{lang}".encode()) % LANGS] = 1
    size = max(0, n_chars or 0)
    out[SOURCES + LANGS :] = [n_chars is None, np.log1p(size) / 12, (np.log1p(size) / 12) ** 2, size < 40]
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Logistic:
    """Logistic regression on standardised features, fitted by Newton steps with an L2 penalty."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.ones(0))
    w: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def fit(self, x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = self._design(x)
        self.w = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], penalty)
        ridge[-1] = 1e-6
        for _ in range(25):
            p = sigmoid(z @ self.w)
            slope = z.T @ (p - y) + ridge * self.w
            bend = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(bend, slope)
            self.w -= step
            if np.abs(step).max() < 1e-6:
                break
        return self

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[(x - self.mean) / self.spread, np.ones(len(x))]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._design(x) @ self.w, -35, 35)


def platt(log_odds: np.ndarray, y: np.ndarray) -> Logistic:
    """Log-odds of good quality from those of a view, or of both."""
    aim = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    return Logistic().fit(log_odds, aim, 0.1)


@dataclass
class Model:
    content: Logistic
    metadata: Logistic
    content_odds: Logistic
    metadata_odds: Logistic
    combined: Logistic
    given: list  # pseudo-labels handed over in each round: (by content, by metadata)

    def views(self, c: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality by each view."""
        first = self.content_odds.log_odds(self.content.log_odds(c)[:, None])
        second = self.metadata_odds.log_odds(self.metadata.log_odds(m)[:, None])
        return sigmoid(first), sigmoid(second)

    def probability(self, c: np.ndarray, m: np.ndarray) -> np.ndarray:
        both = np.c_[self.content.log_odds(c), self.metadata.log_odds(m)]
        return sigmoid(self.combined.log_odds(both))


def _features(batch: pa.RecordBatch, names: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Both views of the rows of a batch."""
    text, source, lang, size = (batch.column(names[k]).to_pylist() for k in ("text", "source", "lang", "n_chars"))
    c = np.array([content_features(t) for t in text], np.float16).reshape(len(text), -1)
    m = np.array([metadata_features(*r) for r in zip(source, lang, size)], np.float16).reshape(len(text), -1)
    return c, m


NAMES = {"text": "text", "source": "source", "lang": "lang", "n_chars": "n_chars"}


def feature_table(docs: DataFrame, ident: str = "doc_id", names: dict[str, str] = NAMES) -> DataFrame:
    """`_id, _c, _m`: both views of every document that has an id."""
    needed = docs.where(F.col(ident).isNotNull()).select(F.col(ident).alias("_id"), *[F.col(v).alias(k) for k, v in names.items()])
    needed = needed.withColumns({"source": F.col("source").cast("string"), "lang": F.col("lang").cast("string")})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in few_rows(whole, "text"):
                c, m = _features(batch, NAMES)
                views = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (c, m)]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), *views], names=["_id", "_c", "_m"])

    return needed.mapInArrow(work, T.StructType([needed.schema["_id"], *[T.StructField(n, T.BinaryType()) for n in ("_c", "_m")]]))


def _matrices(table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(
        np.frombuffer(b"".join(table.column(k).to_pylist()), np.float16).reshape(table.num_rows, -1).astype(np.float64)
        for k in ("_c", "_m")
    )


def _digest(c: bytes, m: bytes) -> bytes:
    return hashlib.md5(c + m).digest()


def _most_certain(unlabelled: DataFrame, model: Model, growth: int, taken: list[set[bytes]]) -> pa.Table:
    """The unlabelled documents of which a view is most certain, for each view and class at most
    `growth`, with their features: one of equal features, and none whose features the view has handed
    over before (`taken`, digests for each view)."""
    shared = unlabelled.sparkSession.sparkContext.broadcast((model, taken))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            model, taken = shared.value
            views = model.views(*_matrices(batch))
            batch = batch.append_column("_key", pa.array([_digest(c.as_py(), m.as_py()) for c, m in zip(batch["_c"], batch["_m"])]))
            keys = np.array(batch["_key"].to_pylist(), object)
            # The smallest id of each feature row.
            order = pa.compute.sort_indices(batch, [("_key", "ascending"), ("_id", "ascending")]).to_numpy()
            first = order[np.r_[True, keys[order][1:] != keys[order][:-1]]]
            for number, p in enumerate(views):
                new = np.sort([i for i in first if keys[i] not in taken[number]]).astype(np.int64)
                for label, sure in ((1, p), (0, 1 - p)):
                    at = new[sure[new] >= CERTAIN]
                    at = at[np.argsort(-sure[at], kind="stable")]
                    at = at[sure[at] >= sure[at][min(growth, len(at)) - 1]] if len(at) else at
                    picked = batch.take(pa.array(at))
                    marks = [pa.array(np.full(len(at), v)) for v in (number, label)]
                    yield pa.RecordBatch.from_arrays(
                        [*picked.columns, *marks, pa.array(sure[at])], names=["_id", "_c", "_m", "_key", "view", "label", "sure"]
                    )

    schema = T.StructType(
        [*[unlabelled.schema[n] for n in ("_id", "_c", "_m")]]
        + [T.StructField("_key", T.BinaryType())]
        + [T.StructField("view", T.LongType()), T.StructField("label", T.LongType()), T.StructField("sure", T.DoubleType())]
    )
    found = unlabelled.select("_id", "_c", "_m").mapInArrow(work, schema).groupBy("view", "label", "_key").agg(
        F.min("_id").alias("_id"), F.min("_c").alias("_c"), F.min("_m").alias("_m"), F.max("sure").alias("sure")
    )
    # One ranking for all views and classes: tasks keep their best before anything moves.
    order = Window.partitionBy("view", "label").orderBy(F.col("sure").desc(), "_id", "_key")
    best = found.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= growth)
    return best.toArrow().sort_by([("view", "ascending"), ("label", "ascending"), ("_place", "ascending")])


def co_train(
    docs: DataFrame,
    labels: DataFrame,
    ident: str = "doc_id",
    label: str = "quality",
    names: dict[str, str] = NAMES,
    fit_rows: int = FIT_ROWS,
    rounds: int = ROUNDS,
    growth: int = GROWTH,
) -> Model | None:
    """A model of good quality (label 1); null without labels of both classes.

    About `fit_rows` labelled documents, half of each class, chosen by a digest of their id, are used: every fifth for
    calibration, the others to fit. What is handed over in a round is in the proportion of the classes,
    `growth` of the more frequent one at most.
    """
    known = labels.where(F.col(ident).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(ident).alias("_id")).agg((F.max(label) > 0).cast("int").alias("_label"))
    table = written(feature_table(docs, ident, names).join(known, "_id", "left"), "features")
    sizes = {r[0]: r[1] for r in table.groupBy("_label").agg(F.count(F.lit(1))).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    place = F.conv(F.substring(F.md5(F.col("_id").cast("string")), 1, 8), 16, 10).cast("double") / 2.0**32
    # Half of the sample for each class; what one leaves goes to the other.
    share = [min(1.0, max(fit_rows / 2, fit_rows - sizes[1 - v]) / sizes[v]) for v in (0, 1)]
    chosen = place < F.when(F.col("_label") == 1, share[1]).otherwise(share[0])
    sample = table.where(F.col("_label").isNotNull() & chosen).withColumn("_place", place).toArrow()
    sample = sample.sort_by([("_place", "ascending"), ("_id", "ascending"), ("_c", "ascending")])
    c, m = _matrices(sample)
    y = sample.column("_label").to_numpy().astype(np.float64)
    if len(set(y.tolist())) < 2:
        return None
    back = np.arange(len(y)) % 5 == 4
    if len(set(y[back].tolist())) < 2 or len(set(y[~back].tolist())) < 2:
        back = np.ones(len(y), bool)
    fit = ~back if not back.all() else back
    held = {"c": [c[fit], y[fit]], "m": [m[fit], y[fit]]}
    given, taken = [], [set(), set()]

    def model() -> Model:
        content, metadata = Logistic().fit(*held["c"]), Logistic().fit(*held["m"])
        odds = content.log_odds(c[back]), metadata.log_odds(m[back])
        fitted = [platt(x, y[back]) for x in (odds[0][:, None], odds[1][:, None], np.c_[odds[0], odds[1]])]
        for each in fitted:  # odds among all labelled documents, not among the sample
            each.w[-1] -= np.log(share[1] / share[0])
        return Model(content, metadata, *fitted, given)

    unlabelled = table.where(F.col("_label").isNull())
    for _ in range(rounds):
        found = _most_certain(unlabelled, model(), growth, taken)
        handed = [0, 0]
        views, classes = (found.column(k).to_numpy() for k in ("view", "label"))
        keys = found.column("_key").to_pylist()
        fc, fm = _matrices(found) if found.num_rows else (None, None)
        for view, other, features in ((0, "m", fm), (1, "c", fc)):
            for value in (0, 1):
                at = np.flatnonzero((views == view) & (classes == value))
                fair = int(np.ceil(growth * sizes[value] / max(sizes[0], sizes[1])))
                at = at[:fair]
                taken[view].update(keys[i] for i in at)
                handed[view] += len(at)
                if len(at):
                    held[other][0] = np.r_[held[other][0], features[at]]
                    held[other][1] = np.r_[held[other][1], np.full(len(at), float(value))]
        given.append(tuple(handed))
        if not sum(handed):
            break
    return model()


def score(docs: DataFrame, model: Model | None, names: dict[str, str] = NAMES, out: str = "quality_score") -> DataFrame:
    """`docs` with the combined probability of good quality of every document, and that of each view
    (`out` with `_content` and `_metadata`)."""
    columns = [out, f"{out}_content", f"{out}_metadata"]
    added = [T.StructField(n, T.DoubleType()) for n in columns]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    typed = {v: T.StringType() for k, v in names.items() if k in ("source", "lang")}
    docs = docs.withColumns({v: F.col(f"`{v}`").cast(kind) for v, kind in typed.items() if docs.schema[v].dataType != kind})

    def compute(found: dict[str, pa.Array]) -> list[pa.Array]:
        if shared.value is None:
            return [pa.array(np.ones(len(found[names["text"]]))) for _ in columns]
        batch = pa.RecordBatch.from_arrays(list(found.values()), names=list(found))
        views = [x.astype(np.float64) for x in _features(batch, names)]
        return [pa.array(x) for x in (shared.value.probability(*views), *shared.value.views(*views))]

    return add_columns(docs, added, compute, list(names.values()), names["text"])
