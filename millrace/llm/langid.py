"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes a blank, and runs of one to three characters are
hashed. A feature is the share of an n-gram in its text times its inverse document frequency over all
training documents. The weights are fitted on a bounded sample of them (`FIT_ROWS` for each language)
by follow-the-regularised-leader with L1 and L2 penalties, which leaves most of them zero; every fifth
document of the sample is kept back to set the temperature of the probabilities.

Defined results: null text and text without a letter are `und` with score 0; without any training
document all texts are `und`; ties go to the language that sorts first; repeated rows get one answer;
other columns are kept, but one named like a result is replaced. Only the text is read for a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .chars import LETTER, add_columns, char_classes, code_points

BITS, SCALE = 18, 100.0
FIT_ROWS = 600  # documents of a language in the fit, about
SLICE = 1 << 20  # characters hashed at once
UNKNOWN = "und"


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, in slices that overlap so that none is lost."""
    points = code_points((text or "").lower())
    letters = char_classes()[points] == LETTER
    if not letters.any():
        return
    plain = np.where(letters, points, np.uint32(32))
    kept = letters.copy()
    kept[1:] |= letters[:-1]  # the first of a run of blanks
    plain = np.r_[np.uint32(32), plain[kept], np.uint32(32)].astype(np.uint64)
    for start in range(0, len(plain), SLICE):
        part = plain[start : start + SLICE + 2]
        first = part[:SLICE]
        two = part[:-1][:SLICE] * np.uint64(0x9E3779B1) + part[1 : 1 + SLICE] if len(part) > 1 else part[:0]
        three = two[: len(part) - 2] * np.uint64(0x85EBCA77) + part[2 : 2 + SLICE] if len(part) > 2 else part[:0]
        for order, value in enumerate((first, two, three)):
            yield ((value + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int32)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text and how often each occurs."""
    found = list(grams(text))
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.unique(np.concatenate(found), return_counts=True)


def document_counts(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each n-gram occurs, and the number of texts with any. Tasks add up their
    own texts; what reaches the driver is one number for each of the 2^18 hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((1 << BITS) + 1, np.int64)
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            for value in batch.column(0):
                for part in grams(value.as_py()):
                    seen[part] = True
                there = np.flatnonzero(seen)
                counts[there] += 1
                counts[-1] += len(there) > 0
                seen[there] = False
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["g", "n"])

    found = docs.select(text).mapInArrow(work, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((1 << BITS) + 1, np.int64)
    counts[found.column("g").to_numpy()] = found.column("n").to_numpy()
    return counts[:-1], int(counts[-1])


@dataclass
class Model:
    languages: list[str]
    row_of: np.ndarray  # the row of `weights` of each hash; 0 has only zeros
    weights: np.ndarray  # rows by languages, with the inverse document frequency in them
    bias: np.ndarray
    temperature: float

    def probabilities(self, text: str | None) -> np.ndarray | None:
        """Of each language, or null for text without a letter."""
        total, sums = 0, np.zeros(len(self.languages))
        for part in grams(text):
            rows = self.row_of[part]
            total += len(part)
            sums += self.weights[rows].sum(axis=0, dtype=np.float64)
        if not total or not self.languages:
            return None
        return softmax((sums / total + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader with per-coordinate steps (McMahan et al., 2013)."""

    def __init__(self, features: int, classes: int, alpha=0.5, beta=1.0, l1=0.05, l2=1e-3):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(x @ w)
        error[label] -= 1
        g = x[:, None] * error[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fitted(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 3) -> Model:
    """A model from (language, n-grams, counts); the order of `rows` is that of learning."""
    languages = sorted({r[0] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    bias_at = len(idf)
    data = [
        (np.r_[at, bias_at], np.r_[SCALE * count / count.sum() * idf[at], 1.0], number[name]) for name, at, count in rows
    ]
    kept_back = data[4::5] if len(data) >= 10 else data
    learned = [d for i, d in enumerate(data) if i % 5 != 4] if len(data) >= 10 else data
    leader = Leader(bias_at + 1, len(languages))
    for _ in range(epochs):
        for at, x, label in learned:
            leader.learn(at, x, label)
    w = leader.weights(slice(None))
    logits = np.array([x @ w[at] for at, x, _ in kept_back])
    truth = np.array([label for *_, label in kept_back])
    # Smoothed targets keep the temperature above 0 where the documents kept back are all right.
    rest = 1 / (len(truth) + 2)
    aim = np.full(logits.shape, rest / max(1, len(languages) - 1))
    aim[np.arange(len(truth)), truth] = 1 - rest
    choices = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-(aim * np.log(softmax(logits / t) + 1e-12)).sum(axis=1).mean() for t in choices]
    full = w[:-1] * (SCALE * idf)[:, None]
    used = np.flatnonzero(np.any(full != 0, axis=1))
    row_of = np.zeros(len(idf), np.int32)
    row_of[used] = np.arange(1, len(used) + 1)
    table = np.vstack([np.zeros((1, len(languages))), full[used]]).astype(np.float32)
    return Model(languages, row_of, table, w[-1], float(choices[int(np.argmin(loss))]))


def train(
    docs: DataFrame, eligible: Column, text: str = "text", lang: str = "lang", ident: str = "doc_id", fit_rows: int = FIT_ROWS
) -> Model:
    """A model learned from the text and language of eligible rows only. Document frequencies are of
    all of them. The fit takes about `fit_rows` documents of each language, chosen and ordered by a
    digest of the id; of a rarer language it takes all."""
    rows = docs.where(eligible & F.col(lang).isNotNull())
    frequency, texts = document_counts(rows, text)
    idf = np.log((1 + texts) / (1 + frequency)) + 1
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).agg(F.count(F.lit(1))).collect()}
    if not sizes or not texts:
        return Model([], np.zeros(1 << BITS, np.int32), np.zeros((1, 0), np.float32), np.zeros(0), 1.0)
    place = F.conv(F.substring(F.md5(F.coalesce(F.col(ident).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / 2.0**32
    share = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, fit_rows / n)))]), F.col(lang))
    sample = rows.where(place < share).select(F.col(lang).alias("lang"), place.alias("place"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counted(t) for t in batch.column("text").to_pylist()]
            at = pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary())
            count = pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), at, count], names=["lang", "place", "at", "n"])

    chosen = sample.mapInArrow(work, "lang string, place double, at binary, n binary").toArrow().to_pylist()
    chosen.sort(key=lambda r: (r["place"], r["lang"], r["at"]))
    seen = [(r["lang"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["n"], np.int32)) for r in chosen if r["at"]]
    return fitted(seen, idf)


def predict(docs: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the language of each whole text and its calibrated probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(columns: dict[str, pa.Array]) -> list[pa.Array]:
        learned, names, scores = shared.value, [], []
        for value in columns[text]:
            p = learned.probabilities(value.as_py())
            names.append(UNKNOWN if p is None else learned.languages[int(p.argmax())])
            scores.append(0.0 if p is None else float(p.max()))
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    added = [T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())]
    return add_columns(docs, added, compute, [text], text)
