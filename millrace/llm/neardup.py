"""Near-duplicate documents by Order MinHash and banded alignment.

Words are runs of letters and digits in lower case. Runs of three words are k-mers, labelled with
their occurrence in the text. Each of `SKETCHES` hash functions picks the two labelled k-mers of smallest hash
and keeps them in the order of the text, so a sketch agrees when both the k-mers and their order do: the
chance of that follows the edit similarity (Marcais et al., 2019). Documents meet in buckets of equal
sketches. A pair counts when a banded alignment of the words finds an edit similarity of at least
`SIMILARITY`, 1 - distance / longer length. Groups are the connected components of the pairs that count.

In every bucket each document is first compared with the smallest id, which gives one pair for each. Where
links join a bucket into one component, nothing is left to do. In the others every document outside the
largest component looks through all documents of other components, tile by tile: counts of its words in
`BINS` bins bound the distance from below and rule out most. Of those left it names the nearest few, they
are aligned, and components grow, round by round while that finds links; then all the pairs left between
different components are aligned. So no pair of a bucket is passed over, while copies that a chain of links
joins are not compared with each other.

Equal texts are collapsed first and need no comparison. No bucket is cut.

Defined results: null text is alone in its group; texts without a word form groups by equal text; a text
of fewer than three words is one k-mer; very long texts are read whole, in slices; an id with several texts
links the groups of none of them, and its rows may lie in several groups; rows without an id take part
by their text; an empty table gives no rows; only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import written
from .chars import DIGIT, LETTER, char_classes, code_points, few_records, few_rows, mixed
from .components import components

PICKED, SKETCHES, SIMILARITY = 2, 40, 0.8
RUN = 3  # words of the k-mers in the buckets: at a similarity of 0.8 runs of three agree far more often than of five
BAND, CELLS, HELD = 16, 1 << 16, 1 << 21  # first width of an alignment; cells of a step and words of pairs that run together
BINS, TILE = 512, 1024  # bins of the word counts, documents of a tile, about
NEAREST = 4  # partners a document names in a round, before all are looked at
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word of a text, in order."""
    points = code_points(text.lower())
    kind = char_classes()[points]
    inside = np.r_[False, (kind == LETTER) | (kind == DIGIT), False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    # A polynomial of the characters: by running sums, longer words in further rounds of one character.
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    begin, many = starts[order], np.searchsorted(-length[order], -np.arange(1, length.max() + 1), "right")
    value = np.zeros(len(starts), np.uint64)
    for i, n in enumerate(many.tolist()):
        value[:n] = value[:n] * np.uint64(0x100000001B3) + points[begin[:n] + i] + np.uint64(1)
    out = np.empty(len(starts), np.uint64)
    out[order] = mixed(value * _BASE + length[order].astype(np.uint64))
    return out


def labelled_kmers(words: np.ndarray, k: int = RUN) -> np.ndarray:
    """Hashes of the runs of k words, each with its number among equal runs."""
    if not len(words):
        return words
    size = max(1, len(words) - k + 1)
    runs = np.zeros(size, np.uint64)
    for i in range(min(k, len(words))):
        runs = runs * np.uint64(0x880355F21E6D1965) + words[i : i + size]
    runs = mixed(runs)
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    place = np.arange(size) - np.maximum.accumulate(np.where(first, np.arange(size), 0))
    out = np.empty(size, np.uint64)
    out[order] = mixed(ranked + place.astype(np.uint64) * _BASE)
    return out


def sketch(words: np.ndarray, k: int = RUN) -> np.ndarray:
    """The order sketches of a text: for each hash function the two labelled k-mers of smallest hash,
    hashed together in text order."""
    kmers = labelled_kmers(words, k)
    rows = np.arange(SKETCHES)
    low = np.full((SKETCHES, PICKED), np.uint64(2**64 - 1))
    at = np.zeros((SKETCHES, PICKED), np.int64)
    for start in range(0, len(kmers), 1 << 15):  # slices, so that long texts take little memory
        part = kmers[start : start + (1 << 15)]
        hashed = part[None, :] * _SEEDS[:, None]
        hashed ^= hashed >> np.uint64(29)
        for _ in range(min(PICKED, len(part))):
            where = hashed.argmin(axis=1)
            value = hashed[rows, where]
            hashed[rows, where] = np.uint64(2**64 - 1)
            worst = low.argmax(axis=1)
            better = value < low[rows, worst]
            low[rows[better], worst[better]] = value[better]
            at[rows[better], worst[better]] = where[better] + start
    if len(kmers) < PICKED:
        at = at[:, :1]
    at.sort(axis=1)
    value = np.zeros(SKETCHES, np.uint64)
    for i in range(at.shape[1]):
        value = mixed(value * np.uint64(0xD6E8FEB86659FD93) + kmers[at[:, i]])
    return value


def banded_distance(a: list[np.ndarray], b: list[np.ndarray], band: int) -> np.ndarray:
    """Edit distances of pairs of word sequences, aligned within `band` places of the diagonal: exact
    where at most `band`, else an upper bound (the sum of lengths where no alignment stays inside).

    All pairs run together, a counterdiagonal of each alignment at a time: its cells follow only from the
    two counterdiagonals before. Those of even number hold the even distances from the diagonal, those of
    odd number the odd ones. Cells before the first word are far away and those behind the last one lead to none
    that is asked for, so that neither needs a mask.
    """
    band += band % 2
    n, m = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    last = int((n + m).max(initial=0))
    top, low = (last + band) // 2 + 1, band // 2 + 1
    left = np.zeros((top + low + 1, len(a)), np.uint32)  # word i (from 1) in row top - i, word j below in row low + j
    right = np.zeros((top + low + 1, len(a)), np.uint32)
    for at, (x, y) in enumerate(zip(a, b)):
        x, y = x[: top - 1], y[: top]
        left[top - len(x) : top, at] = x[::-1]
        right[low + 1 : low + 1 + len(y), at] = y
    kind, far = (np.int16, 16000) if last + band < 15000 else (np.int32, 1 << 29)
    even = np.full((band + 1, len(a)), far, kind)
    even[band // 2] = 0
    odd = np.full((band + 2, len(a)), far, kind)  # a row that stays far at both ends
    other, spare = np.empty((band + 1, len(a)), bool), np.empty((band + 1, len(a)), kind)
    result = n + m
    ends = np.flatnonzero((np.abs(m - n) <= band) & (result > 0))
    ends = ends[np.argsort(result[ends], kind="stable")]
    when, next_ = result[ends], 0
    for d in range(1, last + 1):
        cells, size = (odd[1:-1], band) if d % 2 else (even, band + 1)
        before = even if d % 2 else odd
        r, s = top - (d + size - 1) // 2, low + (d - size + 1) // 2
        np.not_equal(left[r : r + size], right[s : s + size], out=other[:size])
        np.add(cells, other[:size], out=cells)
        np.minimum(before[:-1], before[1:], out=spare[:size])
        np.add(spare[:size], 1, out=spare[:size])
        np.minimum(cells, spare[:size], out=cells)
        while next_ < len(ends) and when[next_] == d:
            at = ends[next_]
            result[at] = min(result[at], int(cells[(m[at] - n[at] + size - 1) // 2, at]))
            next_ += 1
    return result


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays share, counted as often as in both."""
    at = np.searchsorted(b, a, "left") + (np.arange(len(a)) - np.searchsorted(a, a, "left"))
    at = at[at < np.searchsorted(b, a, "right")] if len(a) else at
    return len(at)


def least_distance(a: np.ndarray, b: np.ndarray) -> int:
    """A bound of the edit distance from below, by counting: an edit spoils one word, and at most two pairs of
    neighbouring words."""
    longer = max(len(a), len(b))
    least = max(longer - min(len(a), len(b)), longer - _shared(np.sort(a), np.sort(b)))
    if min(len(a), len(b)) > 1:
        pairs = [np.sort(x[:-1].astype(np.uint64) << np.uint64(32) | x[1:]) for x in (a, b)]
        least = max(least, (longer - _shared(*pairs)) // 2)
    return least


def similar(pairs: list[tuple[np.ndarray, np.ndarray]], least: float = SIMILARITY) -> np.ndarray:
    """Edit similarities of pairs of word sequences where an alignment gives at least `least`, else 0. Bands widen
    from `BAND` to the largest distance that counts, for the pairs that a narrower one leaves open; bands below
    what counting leaves possible are passed over."""
    out = np.zeros(len(pairs))
    longer = np.array([max(len(a), len(b)) for a, b in pairs], np.int64)
    most = np.floor((1 - least) * longer + 1e-9).astype(np.int64)
    lower = np.zeros(len(pairs), np.int64)
    for i, (a, b) in enumerate(pairs):
        if len(a) == len(b) and np.array_equal(a, b):
            out[i] = 1.0
        elif longer[i] - min(len(a), len(b)) > most[i]:
            lower[i] = most[i] + 1
        else:
            lower[i] = least_distance(a, b)
    waiting = np.flatnonzero((out == 0) & (lower <= most))
    waiting = waiting[np.argsort(longer[waiting], kind="stable")]
    band = BAND
    while len(waiting):
        open_, left = waiting[lower[waiting] <= band], [waiting[lower[waiting] > band]]
        start = 0
        while start < len(open_):
            end = start + 1
            while end < len(open_) and end - start < 512:
                of_all = end + 1 - start
                if of_all * min(band, most[open_[end]]) > CELLS or of_all * (longer[open_[end]] + band) > HELD:
                    break
                end += 1
            part = open_[start:end]
            width = int(min(band, most[part].max()))
            found = banded_distance([pairs[i][0] for i in part], [pairs[i][1] for i in part], width)
            good = found <= most[part]
            # What a band accepts is a true alignment; only a band as wide as the limit may reject.
            out[part[good]] = 1 - found[good] / longer[part[good]]
            left.append(part[~good & (most[part] > width)])
            start = end
        waiting, band = np.concatenate(left), band * 4
        waiting = waiting[np.argsort(longer[waiting], kind="stable")]
    return out


def counted(words: np.ndarray) -> np.ndarray:
    """How many words fall into each bin, at most 255. The counts of two texts differ by no more than
    the multisets of their words do."""
    return np.minimum(np.bincount(words & np.uint32(BINS - 1), minlength=BINS), 255).astype(np.uint8)


def sketched(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """`_id, _digest, _sketch, _words, _n` of every row. The words are 32-bit hashes, `_n` is their
    number; without words or text there is no sketch."""
    rows = docs.select(F.col(ident).cast("long").alias("_id"), F.md5(text).alias("_digest"), F.col(text).alias("_text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in few_rows(whole, "_text"):
                hashes = [word_hashes(v.as_py() or "") for v in batch.column("_text")]
                sketches = [sketch(w).view(np.int64) if len(w) else None for w in hashes]
                short = [(w >> np.uint64(32)).astype(np.uint32) for w in hashes]
                columns = [
                    pa.array(sketches, pa.list_(pa.int64())),
                    pa.array([w.tobytes() for w in short], pa.binary()),
                    pa.array([len(w) for w in hashes], pa.int64()),
                ]
                names = ["_id", "_digest", "_sketch", "_words", "_n"]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_digest"), *columns], names=names)

    return rows.mapInArrow(work, "_id long, _digest string, _sketch array<long>, _words binary, _n long")


def buckets(rows: DataFrame) -> DataFrame:
    """`key, _at, _id, _n, head, head_n` of documents `_id, _sketch, _n` in each bucket of more than one; the
    head is the smallest id."""
    members = rows.select("_id", "_n", F.posexplode("_sketch").alias("_at", "_value"))
    members = members.select("_id", "_n", F.col("_at").cast("short").alias("_at"), F.xxhash64("_at", "_value").alias("key"))
    heads = members.groupBy("key").agg(
        F.min("_id").alias("head"), F.min_by("_n", "_id").alias("head_n"), F.count(F.lit(1)).alias("n")
    )
    return members.join(heads.where("n > 1").drop("n"), "key")


def head_pairs(shared: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """`a, b` (a < b) of the members of `buckets` and their heads. Pairs whose numbers of words alone rule
    out the similarity are left out."""
    pairs = shared.where("_id <> head").where(F.least("_n", "head_n") >= F.greatest("_n", "head_n") * least - 1e-6)
    return pairs.select(F.col("head").alias("a"), F.col("_id").alias("b")).distinct()


def candidate_pairs(rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """`a, b` (a < b) of documents `_id, _sketch, _n` and the heads of their buckets."""
    return head_pairs(buckets(rows), least)


def near(bins: np.ndarray, sizes: np.ndarray, at: int, others: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the other texts may be similar to a text by their word counts, and the least share of
    words that differs. A distance is at least the words that one text has and the other lacks."""
    longer = np.maximum(sizes[others], sizes[at])
    most = (1 - least) * longer + 1e-6
    fit = np.abs(sizes[others] - sizes[at]) <= most
    others, longer, most = others[fit], longer[fit], most[fit]
    apart = bins[others] - bins[at]
    lower = (np.abs(apart).sum(axis=1) + np.abs(apart.sum(axis=1))) / 2
    fit = lower <= most
    return others[fit], lower[fit] / longer[fit]


def open_members(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """`key, _at, _id, _n, _root, outside, tiles, _tile` of members of buckets with several components; `outside`
    are those that are not in the largest one. Heads have been compared with all of their bucket."""
    known = roots.select(F.col("node").alias("_id"), F.col("root").alias("_root"))
    members = shared.where("_id <> head").select("key", "_at", "_id", "_n").join(known, "_id", "left")
    members = written(members.withColumn("_root", F.coalesce("_root", "_id")), "members")
    parts = members.groupBy("key", "_root").agg(F.count(F.lit(1)).alias("n"))
    open_ = parts.groupBy("key").agg(
        F.max(F.struct("n", "_root"))["_root"].alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")
    )
    open_ = open_.where("parts > 1").select("key", "main", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    tiled = members.join(open_, "key").withColumn("_tile", F.pmod(F.xxhash64("_id"), "tiles").cast("int"))
    return tiled.withColumn("outside", F.col("_root") != F.col("main")).drop("main")


def signed(singles: DataFrame, members: DataFrame) -> DataFrame:
    """`_id, _bins, _sketch` of the members: what tiles need to know of a text."""
    # A merge join at every size, as in `verified`.
    needed = singles.select("_id", "_words", "_sketch").hint("merge").join(members.select("_id").distinct(), "_id", "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [counted(np.frombuffer(w.as_py(), np.uint32)).tobytes() for w in batch.column("_words")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(bins, pa.binary()), batch.column("_sketch")], names=["_id", "_bins", "_sketch"]
            )

    return needed.mapInArrow(work, "_id long, _bins binary, _sketch array<long>")


def rest_pairs(members: DataFrame, signs: DataFrame, nearest: int | None, least: float = SIMILARITY) -> DataFrame:
    """`a, b` (a < b) of the pairs of a bucket that lie in different components and may be similar by their
    word counts: all of them, or of each member outside the largest component the `nearest`, those with most
    equal sketches. A pair that shares several buckets is looked at in the first of them only."""
    full = members.join(signs, "_id")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    full = full.withColumn("_other", other).select(
        "key", F.least("_tile", "_other").alias("i"), F.greatest("_tile", "_other").alias("j"),
        "_at", "_id", "_n", "_root", "_tile", "outside", "_bins", "_sketch",
    )
    full = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs_of(rows: pa.Table) -> pa.RecordBatch:
        ids, sizes, roots, tile = (rows.column(k).to_numpy() for k in ("_id", "_n", "_root", "_tile"))
        outside = rows.column("outside").to_numpy(zero_copy_only=False)
        counts = np.frombuffer(b"".join(rows.column("_bins").to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
        sketches = rows.column("_sketch").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        bucket = rows.column("_at")[0].as_py()
        apart = rows.column("i")[0].as_py() != rows.column("j")[0].as_py()
        left, right, rank = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for at in np.flatnonzero(outside):
            others = roots != roots[at]
            if apart:
                others &= tile != tile[at]
            if nearest is None:  # a pair of two members outside is named by the smaller
                others &= ~outside | (ids > ids[at])
            others = np.flatnonzero(others)
            equal = sketches[others] == sketches[at]
            here = ~equal[:, :bucket].any(axis=1)
            others, differ = others[here], (1 - equal[here].mean(axis=1))
            fit, share = near(counts, sizes, at, others, least)
            differ = differ[np.isin(others, fit, assume_unique=True)] + share / 1000
            if nearest is not None:
                kept = np.lexsort((ids[fit], differ))[:nearest]
                fit, differ = fit[kept], differ[kept]
            left.append(np.full(len(fit), ids[at]))
            right.append(ids[fit])
            rank.append(differ)
        columns = [pa.array(np.concatenate(c)) for c in (left, right, rank)]
        return pa.RecordBatch.from_arrays(columns, names=["x", "y", "differ"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[pa.Table] = []  # of the group that goes on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.concat_tables([*left, pa.Table.from_batches([batch])])
            key, i, j = (table.column(k).to_numpy() for k in ("key", "i", "j"))
            new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            edges = [0, *new.tolist()]
            for start, end in zip(edges, edges[1:]):
                yield pairs_of(table.slice(start, end - start))
            left = [table.slice(edges[-1])]
        for table in left:
            yield pairs_of(table)

    named = full.mapInArrow(work, "x long, y long, differ double")
    if nearest is not None:
        order = Window.partitionBy("x").orderBy("differ", "y")
        named = named.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= nearest)
    return named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`node, root` after further links: components of the components that the links join."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
        ends = ends.join(known, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    moved = written(components(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "moved")
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    old = roots.join(to, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return old.union(moved.join(roots, "node", "left_anti").select("node", "root"))


def verified(pairs: DataFrame, words: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """`a, b, similarity` of the pairs that are similar enough. `words` has `_id, _words`, an id once."""
    ids = pairs.select(F.col("a").alias("_id")).union(pairs.select(F.col("b").alias("_id"))).distinct()
    # Merge joins at every size: which ids are needed grows with the documents.
    needed = written(words.hint("merge").join(ids, "_id", "left_semi"), "words")
    side = lambda n: needed.select(F.col("_id").alias(n), F.col("_words").alias(f"_{n}")).hint("merge")
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "_a", "_b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in few_rows(whole, "_a"):
                texts = [[np.frombuffer(v.as_py(), np.uint32) for v in batch.column(n)] for n in ("_a", "_b")]
                found = similar(list(zip(*texts)), least)
                at = pa.array(np.flatnonzero(found >= least))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(at), batch.column("b").take(at), pa.array(found).take(at)], names=["a", "b", "similarity"]
                )

    return both.mapInArrow(work, "a long, b long, similarity double")


def distinct_texts(rows: DataFrame) -> DataFrame:
    """`_digest, _rep, _rows, _node` of each text: its smallest id, how often it comes, and a number of its
    own: the id, or for further texts of an id, and texts without one, a hash of the text."""
    texts = rows.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(
        F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_rows")
    )
    texts = written(texts, "texts")
    first = texts.where("_rep is not null").groupBy("_rep").agg(F.min("_digest").alias("_digest")).select("_digest", F.lit(True).alias("_first"))
    own = F.when(F.col("_first"), F.col("_rep")).otherwise(F.xxhash64("_digest"))
    return written(texts.join(first, "_digest", "left").withColumn("_node", own).drop("_first"), "texts")


def groups(docs: DataFrame, ident: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """`ident, class_id, class_size, links` for every row: the smallest id of its group, the number of
    rows in the group, and with how many different texts a comparison linked its text. `class_id` is
    null where no row of a group has an id; a row without text is a group of its own, also beside another
    with its id."""
    found = classes(docs, ident, text, least)
    return found.select(F.col("_id").alias(ident), "class_id", "class_size", "links")


def classes(docs: DataFrame, ident: str, text: str, least: float) -> DataFrame:
    """`_id, _digest, _root, class_id, class_size, links` of every row; `_root` tells the group."""
    rows = written(sketched(docs, ident, text), "sketches")
    texts = distinct_texts(rows)
    of_text = rows.where(F.col("_sketch").isNotNull()).drop("_id").dropDuplicates(["_digest"])
    singles = of_text.join(texts.select("_digest", F.col("_node").alias("_id")), "_digest").drop("_digest")
    singles = written(singles, "singles")
    shared = written(buckets(singles.select("_id", "_sketch", "_n")), "buckets")
    words = singles.select("_id", "_words")
    tested = written(head_pairs(shared, least), "pairs")
    with few_records(docs.sparkSession):
        links = written(verified(tested, words, least), "links")
    roots = written(components(links.select("a", "b")), "roots")
    nearest: int | None = NEAREST
    signs = None
    while True:
        members = written(open_members(shared, roots), "members")
        if signs is None:  # later rounds have no further members
            with few_records(docs.sparkSession):
                signs = written(signed(singles, members), "signs")
        named = rest_pairs(members, signs, nearest, least).join(tested, ["a", "b"], "left_anti")
        named = written(named, "pairs")
        with few_records(docs.sparkSession):
            found = written(verified(named, words, least), "links")
        many, good = named.count(), found.count()
        if good:
            links = links.union(found)
            roots = written(joined_roots(roots, found), "roots")
        if nearest is None:
            break
        tested = tested.union(named)
        # Components at least halve where the nearest are similar; where few are, all that is left is looked at.
        if good < many / 4 or not many:
            nearest = None
    degree = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
    degree = degree.groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    classed = texts.join(roots, texts["_node"] == roots["node"], "left").drop("node")
    classed = classed.join(degree, F.col("_node") == degree["node"], "left")
    classed = classed.select("_digest", "_rep", "_rows", F.coalesce("root", "_node").alias("_root"), F.coalesce("links", F.lit(0)).alias("links"))
    classed = written(classed, "classed")
    # Written, so that Spark may split a large group in the joins that hand its size to its rows.
    sizes = classed.groupBy("_root").agg(F.min("_rep").alias("class_id"), F.sum("_rows").alias("class_size"))
    sized = written(classed.join(written(sizes, "sizes"), "_root").drop("_rows", "_rep"), "sized")
    placed = rows.select("_id", "_digest").join(sized, "_digest", "left")
    no_text = F.col("_digest").isNull()
    return placed.select(
        "_id",
        "_digest",
        F.when(no_text, F.xxhash64(F.lit("no text"), "_id")).otherwise(F.col("_root")).alias("_root"),
        F.when(no_text, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(no_text, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def one_of_each(docs: DataFrame, ident: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """`docs` with one document of each group, that of the smallest id; where the group has several texts
    of that id, that of the smallest digest; of rows with equal id and text, one. Documents without an id
    all stay, as no group can name them."""
    found = classes(docs, ident, text, least).where("_id = class_id")
    told = found.groupBy("_root").agg(F.min("_id").alias("_kept_id"), F.min("_digest").alias("_kept_text"))
    told = told.select("_kept_id", F.coalesce("_kept_text", F.lit("")).alias("_kept_text"))
    # Places for names, so that no column of the caller's clashes.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    of = {name: F.col(f"c{i}") for i, name in enumerate(docs.columns)}
    keys = [of[ident].cast("long").alias("_kept_id"), F.coalesce(F.md5(of[text]), F.lit("")).alias("_kept_text")]
    kept = plain.select("*", *keys).join(told, ["_kept_id", "_kept_text"])
    # Maps have no hash; their text has.
    hashed = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in plain.schema.fields]
    first = Window.partitionBy("_kept_id", "_kept_text").orderBy(F.xxhash64(*hashed))
    kept = kept.withColumn("_kept_no", F.row_number().over(first)).where("_kept_no = 1").select(*plain.columns)
    return kept.union(plain.where(of[ident].isNull())).toDF(*docs.columns)
