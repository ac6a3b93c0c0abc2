"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding lower-cases a text, takes marks off letters, turns look-alike letters of other scripts and digits
or signs inside words into the Latin letter they stand for (i, l and 1 into one), and leaves single blanks
between words. The lexicon holds beginnings of folded words. They are learned from labelled documents: a
beginning counts where it is found in far more toxic than clean documents (log-likelihood ratio of document
counts), its weight is the log odds, and of nested beginnings the longest stays that loses few toxic
documents. An occurrence does not count inside an exception phrase: the word and a neighbour, where
labelled documents show the pair mostly in clean ones, or phrases given by the caller. Words are counted
again outside of the phrases before the lexicon is chosen.

The score is logistic in the logarithms of the summed weights and of the number of words, so the sum is
normalised by a power of the length; power and offset are fitted on labelled documents that gave no lexicon.

The fit reads a bounded sample: about `FIT_ROWS` labelled documents of each class, chosen by a digest of the
id; counts of beginnings and phrases in it are Spark aggregates. Scores read every whole text.

Defined results: null text and text without a word have no match and get the score of an empty text; without
a toxic or without a clean labelled document all scores are 0; a document with several labels is toxic if
one says so; null labels are left out; repeated rows get equal scores; very long texts are folded and matched
in slices that end between words; of the caller's columns only id and text are read, others are kept, and a column of
the name of a result is replaced by it.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import written
from .chars import add_columns

FIT_ROWS = 6000  # labelled documents of a class in the fit, about
SHORTEST, LONGEST = 3, 12  # letters of a beginning
EVIDENCE = 25.0  # least log-likelihood ratio of a beginning
LEAST_ODDS = math.log(8)
ENTRIES = 5000  # most beginnings or phrases in a model
SLICE = 1 << 20  # characters folded at once

# Cyrillic, Greek and further letters that look like Latin ones, each above what it looks like.
LOOK_ALIKE = {
    **str.maketrans("авгеікмнопрстухѕјһԁԛԝ",
                    "abreikmhonpctyxsjhdqw"),
    **str.maketrans("αβγεηικνοπρστυχω",
                    "abyenikvonpotuxw"),
    **str.maketrans("ıłøđħ",
                    "ilodh"),
}
# Digits and signs for letters. i, l and 1 become one letter, as 1 stands for either.
DIGITS = str.maketrans("0123456789i", "olzeasgtbgl")
SIGNS = str.maketrans("@$!|€£+", "aslletl")

_SIGN = regex.compile(r"(?<=\w)[@$!|€£+](?=\w)|(?<!\w)[@$](?=\p{L})")
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_MARK = regex.compile(r"\p{M}+")
_HAS_LETTER = regex.compile(r"\p{L}")


def slices(text: str) -> Iterator[str]:
    """Parts of a text of about `SLICE` characters that end at white space, if there is any near."""
    start = 0
    while start < len(text):
        end = start + SLICE
        if end < len(text):
            gap = regex.compile(r"\s").search(text, end, end + SLICE)
            end = gap.end() if gap else end + SLICE
        yield text[start:end]
        start = end


def _folded(token: str) -> str:
    """The folded words of a run without white space, with single blanks between them."""
    plain = unicodedata.normalize("NFKD", token).lower()
    plain = _MARK.sub("", plain).translate(LOOK_ALIKE)
    plain = _SIGN.sub(lambda m: m.group().translate(SIGNS), plain)
    return " ".join(w.translate(DIGITS) for w in _WORD.findall(plain) if _HAS_LETTER.search(w))


_remembered = lru_cache(maxsize=1 << 18)(_folded)


def fold(text: str) -> str:
    """Folded words with a blank before each and after the last; a word is letters and digits with at
    least one letter. Folding looks no further than white space, and most words come again."""
    words = " ".join(filter(None, [_remembered(t) if len(t) < 40 else _folded(t) for t in text.split()]))
    return f" {words} " if words else ""


def covered(phrases: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[bool]:
    """Which spans lie inside one of the phrases, whose last place is a blank."""
    if not phrases:
        return [False] * len(spans)
    phrases = sorted(phrases)
    starts, reach = np.array([p[0] for p in phrases]), np.maximum.accumulate([p[1] for p in phrases])
    out = []
    for start, end in spans:
        at = int(np.searchsorted(starts, start, "right")) - 1
        out.append(at >= 0 and bool(reach[at] >= end))
    return out


@dataclass
class Model:
    """A lexicon of beginnings with weights, exception phrases, and the fitted line of the score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    offset: float = 0.0
    power: float = 0.0
    length_power: float = 0.0
    fitted: bool = False
    _automaton: ahocorasick.Automaton | None = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self) -> ahocorasick.Automaton:
        """Of beginnings after a blank, and of exception phrases between blanks."""
        if self._automaton is None:
            found = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                found.add_word(f" {entry}", (len(entry) + 1, weight))
            for phrase in self.exceptions:
                found.add_word(f" {phrase} ", (len(phrase) + 2, None))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of the beginnings that count: of several at one word the heaviest, none
        inside an exception phrase."""
        if not self.weights or not folded:
            return []
        best: dict[int, tuple[int, float]] = {}
        phrases = []
        for last, (size, weight) in self.automaton().iter(folded):
            start = last + 1 - size
            if weight is None:
                phrases.append((start, last))
            elif start not in best or weight > best[start][1]:
                best[start] = (last + 1, weight)
        inside = covered(phrases, [(start, end) for start, (end, _) in best.items()])
        return sorted((start, end, weight) for (start, (end, weight)), out in zip(best.items(), inside) if not out)

    def open_words(self, folded: str) -> list[str]:
        """The words that lie in no exception phrase."""
        words = folded.split()
        if not self.exceptions or not words:
            return words
        phrases = [(last + 1 - size, last) for last, (size, weight) in self.automaton().iter(folded) if weight is None]
        if not phrases:
            return words
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        inside = covered(phrases, [(e - len(w) - 1, e) for e, w in zip(ends, words)])
        return [w for w, out in zip(words, inside) if not out]

    def measure(self, text: str | None) -> tuple[float, int]:
        """The summed weights and the number of words of a whole text."""
        total, words = 0.0, 0
        for part in slices(text or ""):
            folded = fold(part)
            words += folded.count(" ") - 1 if folded else 0
            total += math.fsum(weight for *_, weight in self.hits(folded))
        return total, words

    def score(self, text: str | None) -> float:
        if not self.fitted:
            return 0.0
        total, words = self.measure(text)
        z = self.offset + self.power * math.log1p(total) - self.length_power * math.log1p(words)
        return 1 / (1 + math.exp(-z)) if z > -500 else 0.0


def beginnings(model: Model, text: str | None) -> set[str]:
    """The beginnings of the words of a text outside exception phrases, each once."""
    words: set[str] = set()
    for part in slices(text or ""):
        words.update(model.open_words(fold(part)))
    return {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """The log-likelihood ratio of document counts against equal rates in both classes."""
    rate = (toxic + clean) / (n_toxic + n_clean)

    def part(seen: np.ndarray, total: int) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            inside = np.where(seen > 0, seen * np.log(seen / (total * rate)), 0.0)
            rest = np.where(seen < total, (total - seen) * np.log((total - seen) / (total * (1 - rate))), 0.0)
        return inside + np.nan_to_num(rest)

    return 2 * (part(toxic, n_toxic) + part(clean, n_clean))


def chosen(
    counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int, least_odds: float = LEAST_ODDS, kept: float = 0.9
) -> dict[str, float]:
    """Weights of the beginnings to use, from their toxic and clean document counts. A beginning gives
    way to a longer one with at least `kept` of its toxic documents; a longer one adds nothing below
    a beginning that is used already, unless it is much clearer."""
    names = sorted(counts)
    toxic = np.array([counts[n][0] for n in names], np.float64)
    clean = np.array([counts[n][1] for n in names], np.float64)
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    good = (evidence(toxic, clean, n_toxic, n_clean) >= EVIDENCE) & (odds >= least_odds)
    weight = {n: float(o) for n, o, g in zip(names, odds, good) if g}
    longer: Counter[str] = Counter()
    for name in weight:
        for end in range(SHORTEST, len(name)):
            longer[name[:end]] = max(longer[name[:end]], counts[name][0])
    used: dict[str, float] = {}
    for name in sorted(weight, key=len):
        if longer[name] >= kept * counts[name][0]:
            continue
        above = [used[name[:end]] for end in range(SHORTEST, len(name)) if name[:end] in used]
        if not above or weight[name] > max(above) + LEAST_ODDS:
            used[name] = weight[name]
    return dict(sorted(used.items(), key=lambda e: (-e[1], e[0]))[:ENTRIES])


def fitted_line(total: np.ndarray, words: np.ndarray, toxic: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Offset, power and power of the length of a logistic score, by Newton steps with a small penalty;
    classes weigh as they come. More weight never lowers a score, more words never raise it."""
    x = np.stack([np.ones(len(total)), np.log1p(total), -np.log1p(words)], axis=1)
    free = [0, 1, 2]
    while True:
        part, w = x[:, free], np.zeros(len(free))
        penalty = np.array([1e-3 if f == 0 else ridge for f in free])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            slope = part.T @ (p - toxic) + penalty * w
            curve = (part * (p * (1 - p) + 1e-9)[:, None]).T @ part + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        below = [f for f, v in zip(free, w) if f and v < 0]
        if not below:
            break
        free = [f for f in free if f not in below]
    full = np.zeros(3)
    full[free] = w
    return float(full[0]), float(full[1]), float(full[2])


def _tally(rows: DataFrame, features) -> DataFrame:
    """`term, toxic, clean`: how many documents of each class have a feature. Tasks add up their own rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for value, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                counts[label].update(features(value.as_py()))
        for label in (0, 1):
            terms, numbers = list(counts[label]), list(counts[label].values())
            for at in range(0, len(terms), 10_000):
                n = pa.array(numbers[at : at + 10_000], pa.int64())
                zero = pa.array(np.zeros(len(n), np.int64))
                both = [n, zero] if label else [zero, n]
                yield pa.RecordBatch.from_arrays([pa.array(terms[at : at + 10_000], pa.string()), *both], names=["term", "toxic", "clean"])

    found = rows.select("text", "toxic").mapInArrow(work, "term string, toxic long, clean long")
    return found.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def labelled(docs: DataFrame, labels: DataFrame, eligible: Column, ident: str, text: str, fit_rows: int) -> DataFrame:
    """`text, toxic, part` of about `fit_rows` documents of each class. Ids are chosen among the labels
    first, so the join hands out a table of bounded size."""
    marks = labels.where(eligible & F.col(ident).isNotNull() & F.col("toxic").isin(0, 1))
    marks = marks.groupBy(F.col(ident).alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r[0]: r[1] for r in marks.groupBy("toxic").agg(F.count(F.lit(1))).collect()}
    digest = F.conv(F.substring(F.md5(F.col("_id").cast("string")), 1, 8), 16, 10).cast("double") / 2.0**32
    share = F.when(F.col("toxic") == 1, min(1.0, fit_rows / sizes.get(1, 1))).otherwise(min(1.0, fit_rows / sizes.get(0, 1)))
    # Another part of the digest says which documents give the lexicon and which the line.
    part = (F.conv(F.substring(F.md5(F.col("_id").cast("string")), 9, 8), 16, 10).cast("long") % 4).cast("int")
    ids = marks.where(digest < share).withColumn("part", part)
    found = docs.select(F.col(ident).alias("_id"), F.col(text).cast("string").alias("text"))
    # A repeated document counts once: the copies of an id with one text are one.
    found = found.join(F.broadcast(ids), "_id").dropDuplicates(["_id", "text"])
    return written(found.select("text", "toxic", "part"), "labelled")


def train(
    docs: DataFrame,
    labels: DataFrame,
    eligible: Column,
    ident: str = "doc_id",
    text: str = "text",
    fit_rows: int = FIT_ROWS,
    exceptions: Sequence[str] = (),
) -> Model:
    """A model learned from `labels` (`ident`, `toxic`) of eligible rows and their texts only.
    `exceptions` are further phrases inside which no word counts."""
    rows = labelled(docs, labels, eligible, ident, text, fit_rows)
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy("toxic", F.col("part") > 0).agg(F.count(F.lit(1))).collect()}
    n_toxic, n_clean = sizes.get((1, True), 0), sizes.get((0, True), 0)
    if not n_toxic or not n_clean:
        return Model()
    learning = rows.where("part > 0")
    # A beginning below this many toxic documents cannot reach the evidence asked for.
    least = max(2, math.floor(EVIDENCE / 2 / math.log((n_toxic + n_clean) / n_toxic + 1)))

    def lexicon(model: Model, least_odds: float) -> dict[str, float]:
        often = F.col("toxic") / n_toxic >= F.col("clean") / n_clean * math.exp(least_odds) / 2
        counts = _tally(learning, lambda t: beginnings(model, t)).where((F.col("toxic") >= least) & often)
        first = counts.orderBy(F.desc("toxic"), "term").limit(20 * ENTRIES).collect()
        return chosen({r["term"]: (r["toxic"], r["clean"]) for r in first}, n_toxic, n_clean, least_odds)

    # Words that toxic documents have somewhat more often show which phrases are harmless; outside of
    # those phrases they are counted again.
    given = tuple(sorted({fold(e).strip() for e in exceptions} - {""}))
    draft = Model(lexicon(Model({}, given), math.log(1.5)), given)
    pairs = _tally(learning, lambda t: neighbours(draft, t)).where(F.col("clean") >= 3)
    # Pairs that clean documents show at least as often as toxic ones, by rate.
    pairs = pairs.where((F.col("clean") + 0.5) / (n_clean + 1) >= (F.col("toxic") + 0.5) / (n_toxic + 1))
    learned = [r["term"] for r in pairs.orderBy(F.desc("clean"), "term").limit(ENTRIES).collect()]
    weights = lexicon(Model({}, (*given, *learned)), LEAST_ODDS)
    needed = [p for p in learned if any(w[:n] in weights for w in p.split() for n in range(SHORTEST, len(w) + 1))]
    model = Model(weights, tuple(sorted({*given, *needed})))
    apart = measured(rows.where("part = 0"), model)
    if len(set(apart["toxic"].tolist())) < 2:
        apart = measured(rows, model)
    line = fitted_line(apart["total"], apart["words"], apart["toxic"])
    return Model(model.weights, model.exceptions, *line, fitted=True)


def neighbours(model: Model, text: str | None) -> set[str]:
    """The words that hold a hit, each with the word before and with the word after it."""
    found = set()
    for part in slices(text or ""):
        folded = fold(part)
        for start, end, _ in model.hits(folded):
            stop = folded.index(" ", end)
            after = folded.find(" ", stop + 1)
            before = folded.rfind(" ", 0, start)
            if after > 0:
                found.add(folded[start + 1 : after])
            if before >= 0:
                found.add(folded[before + 1 : stop])
    return found


def measured(rows: DataFrame, model: Model) -> dict[str, np.ndarray]:
    """Summed weights, words and label of the sampled documents: three numbers each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.measure(v.as_py()) for v in batch.column("text")]
            total, words = pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([total, words, batch.column("toxic")], names=["total", "words", "toxic"])

    found = rows.select("text", "toxic").mapInArrow(work, "total double, words long, toxic int").toArrow()
    columns = {n: found.column(n).to_numpy().astype(np.float64) for n in found.column_names}
    order = np.lexsort((columns["toxic"], columns["words"], columns["total"]))
    return {n: c[order] for n, c in columns.items()}


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(columns: dict[str, pa.Array]) -> list[pa.Array]:
        return [pa.array([shared.value.score(v.as_py()) for v in columns[text]], pa.float64())]

    return add_columns(docs, [T.StructField(out, T.DoubleType())], compute, [text], text)
