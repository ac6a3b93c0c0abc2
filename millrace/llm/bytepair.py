"""Byte-level BPE on whole texts, encoding and decoding, by the ranks of a public vocabulary.

A text is cut by the pattern of the vocabulary; each piece is merged by itself. The pieces of an Arrow
batch that no earlier batch had are dealt to buckets of similar length and merged as matrices: rows are
pieces padded to the bucket's length, cells are token ids. In each round every row merges its leftmost
pair of smallest rank, found by hashed lookup of the two ids, and closes the gap; rows without a pair
leave the matrix.

Defined results: null text is encoded as the empty text, which has no tokens; null ids decode to no
bytes; a text may have any length (a piece above `LONG` bytes is merged by itself, from a heap of its
pairs, as a matrix would take a round of its whole length for each token); repeated rows give repeated results; other columns are kept.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .chars import LETTER, SPACE, char_classes, code_points, add_columns

NO_RANK = np.int32(2**31 - 1)
LONG = 512
MOST_KNOWN = 200_000  # pieces a worker remembers; it forgets all of them when there are more
CELLS = 1 << 20  # of a matrix

_tables: dict[int, tuple] = {}
_known: dict[int, dict] = {}


def pieces(text: str) -> list[str]:
    """The text cut as by the pattern `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
    ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`: at changes of character class, then a blank joins the run
    that follows it, and a lone apostrophe takes its ending."""
    if not text:
        return []
    points = code_points(text)
    kind = char_classes()[points]
    n = len(points)
    cut = np.empty(n + 1, bool)
    cut[0] = cut[n] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:n])
    starts = np.flatnonzero(cut[:n] & (kind != SPACE))
    starts = starts[starts > 0]
    after_space = starts[kind[starts - 1] == SPACE]
    # The last of a run of white space stands alone, or joins what follows if it is a blank.
    cut[after_space - 1] = True
    cut[after_space[points[after_space - 1] == 32]] = False
    mark = np.flatnonzero((points[:-1] == 39) & cut[: n - 1] & cut[1:n] & (kind[1:] == LETTER))
    for i in mark.tolist():
        ending = text[i + 1 : i + 3]
        size = 2 if ending in ("re", "ve", "ll") else 1 if ending[0] in "stmd" else 0
        if size:
            cut[i + 1] = False
            cut[i + 1 + size] = True
    at = np.flatnonzero(cut).tolist()
    return [text[a:b] for a, b in zip(at, at[1:])]


class PairTable:
    """Ranks of mergeable pairs of ids in an open-addressed hash table, looked up for whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, rank = [], [], []
        for token, number in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(number)
        keys = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.bits = max(4, int(len(keys) * 2.5).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        waiting, values, slot = keys, np.array(rank, np.int32), self._slot(keys)
        self.probes = 0
        while len(waiting):
            free = self.keys[slot] == np.uint64(2**64 - 1)
            self.keys[slot[free]] = waiting[free]  # of several for one slot the last stays
            placed = self.keys[slot] == waiting
            self.ranks[slot[placed]] = values[placed]
            waiting, values, slot = waiting[~placed], values[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        found = np.where(self.keys[slot] == keys, self.ranks[slot], NO_RANK)
        open_ = np.flatnonzero((found == NO_RANK) & (self.keys[slot] != np.uint64(2**64 - 1)))
        flat_keys, flat_slot, out = keys, slot, found
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            flat_slot[open_] = (flat_slot[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[flat_slot[open_]]
            hit = there == flat_keys[open_]
            out[open_[hit]] = self.ranks[flat_slot[open_[hit]]]
            open_ = open_[~hit & (there != np.uint64(2**64 - 1))]
        return out


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}


def _table(lines: bytes) -> tuple[PairTable, np.ndarray, list[bytes]]:
    """Pair table, ids of single bytes, bytes of ids; built once in a worker."""
    key = hash(lines)
    if key not in _tables:
        ranks = read_ranks(lines)
        single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        by_id = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            by_id[number] = token
        _tables[key] = PairTable(ranks), single, by_id
    return _tables[key]


def merged(rows: list[bytes], table: PairTable, single: np.ndarray) -> list[bytes]:
    """Token ids (as int32 bytes) of pieces of at most `LONG` bytes, as one matrix."""
    out: list = [None] * len(rows)
    width = max(map(len, rows))
    lengths = np.array([len(r) for r in rows])
    cells = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
    ids = single[cells].astype(np.int32)
    place = np.arange(len(rows))
    ranks = np.full((len(rows), max(width - 1, 1)), NO_RANK, np.int32)
    if width > 1:
        inside = np.arange(1, width)[None, :] < lengths[:, None]
        r, c = np.nonzero(inside)
        ranks[r, c] = table.look_up(ids[r, c], ids[r, c + 1])
    while True:
        at = ranks.argmin(axis=1)  # the leftmost of the smallest
        low = ranks[np.arange(len(ids)), at]
        done = low == NO_RANK
        for i in np.flatnonzero(done).tolist():
            out[place[i]] = ids[i, : lengths[i]].tobytes()
        if done.all():
            return out
        if done.any():
            keep = ~done
            ids, ranks, lengths, place, at, low = (x[keep] for x in (ids, ranks, lengths, place, at, low))
            width = int(lengths.max())
            ids, ranks = ids[:, :width], ranks[:, : width - 1]
        rows_at = np.arange(len(ids))
        # Close the gap: what stands right of the pair moves one to the left.
        columns = np.arange(width - 1)[None, :]
        ids = np.where(columns <= at[:, None], ids[:, :-1], ids[:, 1:])
        ids[rows_at, at] = low
        lengths = lengths - 1
        if width > 2:
            ranks = np.where(columns[:, :-1] <= at[:, None], ranks[:, :-1], ranks[:, 1:])
        else:
            ranks = np.full((len(ids), 1), NO_RANK, np.int32)
        width -= 1
        for offset in (-1, 0):
            first = at + offset
            ok = np.flatnonzero((first >= 0) & (first < width - 1))
            ok = ok[first[ok] + 1 < lengths[ok]]
            f = first[ok]
            ranks[ok, f] = table.look_up(ids[ok, f], ids[ok, f + 1])
            over = np.flatnonzero((first >= 0) & (first < ranks.shape[1]))
            over = over[first[over] + 1 >= lengths[over]]
            ranks[over, first[over]] = NO_RANK


def merged_long(piece: bytes, table: PairTable, single: np.ndarray) -> list[int]:
    """Token ids of one long piece. Its pairs wait in a heap by rank and place, so the work grows
    with its length and not with the square; pairs that a merge has changed are passed over."""
    ids = single[np.frombuffer(piece, np.uint8)].astype(np.int32)
    ranks = table.look_up(ids[:-1], ids[1:])
    heap = [(r, i) for i, r in enumerate(ranks.tolist()) if r != NO_RANK]
    heapq.heapify(heap)
    n, current = len(ids), dict(enumerate(ranks.tolist()))
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    token: list = ids.tolist()
    while heap:
        rank, i = heapq.heappop(heap)
        if current.get(i) != rank:
            continue
        j = after[i]
        token[i], token[j] = rank, None
        current.pop(j, None)
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < n:
                found = int(table.look_up(np.array([token[a]]), np.array([token[after[a]]]))[0])
                current[a] = found
                if found != NO_RANK:
                    heapq.heappush(heap, (found, a))
            else:
                current.pop(a, None)
    return [t for t in token if t is not None]


def encoded_pieces(new: list[str], lines: bytes) -> dict[str, bytes]:
    """Ids (as int32 bytes) of each piece, in buckets of similar length."""
    table, single, _ = _table(lines)
    raw = sorted(((p.encode("utf-8", "surrogatepass"), p) for p in new), key=lambda x: len(x[0]))
    found: dict[str, bytes] = {}
    start = 0
    while start < len(raw):
        size = len(raw[start][0])
        if size > LONG:
            found[raw[start][1]] = np.array(merged_long(raw[start][0], table, single), np.int32).tobytes()
            start += 1
            continue
        most, end = min(LONG, size + max(1, size // 4)), start
        while end < len(raw) and len(raw[end][0]) <= most and (end + 1 - start) * most <= CELLS:
            end += 1
        end = max(end, start + 1)
        for (_, piece), ids in zip(raw[start:end], merged([b for b, _ in raw[start:end]], table, single)):
            found[piece] = ids
        start = end
    return found


def encode_texts(texts: list[str | None], lines: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and where each text's begin."""
    known = _known.setdefault(hash(lines), {})
    cut = [pieces(t or "") for t in texts]
    new = set(chain.from_iterable(cut)).difference(known)
    if len(known) + len(new) > MOST_KNOWN:
        known.clear()
        new = set(chain.from_iterable(cut))
    known.update(encoded_pieces(list(new), lines))
    ids = [b"".join(map(known.__getitem__, c)) for c in cut]
    begins = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(i) // 4 for i in ids], out=begins[1:])
    return np.frombuffer(b"".join(ids), np.int32), begins


def decode_ids(column: pa.ListArray, lines: bytes) -> list[bytes]:
    """The bytes of each list of ids; of null none."""
    by_id = _table(lines)[2]
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [b"".join(map(by_id.__getitem__, flat[a:b].tolist())) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def encode(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """`docs` with the token ids of the text, and in the same pass the bytes that the ids decode to if
    `decoded` names a column. The rank file (a few MB at most) goes to the tasks with the function."""
    with open(ranks_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def compute(columns: dict[str, pa.Array]) -> list[pa.Array]:
        flat, begins = encode_texts(columns[text].to_pylist(), shared.value)
        lists = pa.ListArray.from_arrays(begins.astype(np.int32), flat)
        return [lists, pa.array(decode_ids(lists, shared.value), pa.binary())] if decoded else [lists]

    added = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    added += [T.StructField(decoded, T.BinaryType())] if decoded else []
    return add_columns(docs, added, compute, [text], text)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`encoded` with the bytes of the token ids."""
    with open(ranks_path, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = pa.array(decode_ids(batch.column(ids), shared.value), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], names=[*batch.schema.names, decoded])

    schema = T.StructType([*encoded.schema.fields, T.StructField(decoded, T.BinaryType())])
    return encoded.mapInArrow(work, schema)


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> dict:
    """Columns that sum up ids and decoded bytes."""
    return {
        "n_tokens": F.size(ids).cast("long"),
        "ids_sha256": F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256),
        "decoded_sha256": F.sha2(F.col(decoded), 256),
    }
