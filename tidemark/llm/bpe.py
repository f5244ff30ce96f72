"""Byte-level BPE encoding and decoding with a rank file.

Tier one: a minimal perfect hash over the vocabulary resolves every pre-token that is a
token itself, for a whole slice of text at once.  Tier two: other pre-tokens are merged by
a heap over linked bytes, each distinct one once per slice, behind a worker cache.

Defined results: null and empty texts have no ids; special strings in a text are ordinary
text; very long pre-tokens cost n log n.  Extra columns stay outside.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.pieces import Pieces, gather

#: Most vocabulary bytes that are broadcast; a vocabulary has a fixed size.
MAX_VOCABULARY_BYTES = 64 << 20
#: Most pre-tokens a worker remembers; the oldest half goes when it is full.
CACHE_PIECES = 200_000
_KEYS_PER_BUCKET = 4
_TRIES = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank out of a file of base-64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PerfectHash:
    """Hash and displace: ``n`` keys on exactly ``n`` slots, no empty one.

    A bucket stores a number that moves all its keys to free slots; a bucket of a single
    key stores the slot itself, as a negative number.  A slot keeps its key's hash, so
    foreign keys are told apart.
    """

    def __init__(self, hashes: np.ndarray):
        n = self.n = len(hashes)
        self.buckets = max(1, n // _KEYS_PER_BUCKET)
        self.shift = np.zeros(self.buckets, np.int32)
        self.key = np.zeros(n, np.uint64)
        self.place = np.zeros(n, np.int64)
        if len(np.unique(hashes)) != n:
            raise ValueError("two keys share a hash")
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        first = np.cumsum(sizes) - sizes
        taken = np.zeros(n, bool)
        free = None
        for b in np.argsort(-sizes, kind="stable").tolist():
            own = order[first[b] : first[b] + sizes[b]]
            if len(own) == 0:
                break
            if len(own) == 1:
                free = np.flatnonzero(~taken).tolist() if free is None else free
                slots = np.array([free.pop()])
                self.shift[b] = -1 - slots[0]
            else:
                shift, own_hashes = 0, hashes[own][None, :]
                while True:
                    tries = np.arange(shift, shift + _TRIES)
                    options = np.sort(self._slots(own_hashes, tries[:, None]), axis=1)
                    good = ~taken[options].any(axis=1) & (options[:, 1:] != options[:, :-1]).all(axis=1)
                    if good.any():
                        shift += int(good.argmax())
                        slots = self._slots(own_hashes[0], np.full(len(own), shift))
                        break
                    shift += _TRIES
                self.shift[b] = shift
            taken[slots] = True
            self.place[own] = slots
        self.key[self.place] = hashes

    def _slots(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (tx.mix_with(hashes, shift) % np.uint64(self.n)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        if self.n == 0:
            return np.full(len(hashes), -1)
        shift = self.shift[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(shift < 0, -1 - shift, self._slots(hashes, np.maximum(shift, 0)))
        return np.where(self.key[slots] == hashes, slots, -1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: the pair of lowest rank merges first, the leftmost of equals.

    Parts are linked by their start; a heap entry packs rank, start of the left part and
    end of the right part, and is stale when one of them has changed since.
    """
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    bits = n.bit_length()
    low = (1 << bits) - 1
    end = list(range(1, n + 1))
    before = list(range(-1, n))
    gone = bytearray(n + 1)
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank << 2 * bits) | (i << bits) | (i + 2))
    heapq.heapify(heap)
    while heap:
        entry = heapq.heappop(heap)
        stop = entry & low
        left = (entry >> bits) & low
        right = end[left]
        if gone[left] or right >= n or end[right] != stop or gone[right]:
            continue
        end[left] = stop
        gone[right] = 1
        if stop < n:
            before[stop] = left
            rank = ranks.get(piece[left : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank << 2 * bits) | (left << bits) | end[stop])
        other = before[left]
        if other >= 0:
            rank = ranks.get(piece[other:stop])
            if rank is not None:
                heapq.heappush(heap, (rank << 2 * bits) | (other << bits) | stop)
    ids = []
    at = 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


@dataclass
class Vocabulary:
    ranks: dict[bytes, int]
    table: PerfectHash
    #: Id at each slot of the table.
    ids: np.ndarray
    #: Bytes of all tokens by id, and where each starts.
    arena: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Vocabulary:
        tokens = sorted(ranks, key=ranks.get)
        rank = np.array([ranks[t] for t in tokens], np.int64)
        arena = np.frombuffer(b"".join(tokens), np.uint8)
        length = np.array([len(t) for t in tokens], np.int64)
        start = np.cumsum(length) - length
        table = PerfectHash(tx.span_hashes(tx._BYTE_VALUES[arena], start, start + length))
        ids = np.zeros(len(tokens), np.int32)
        ids[table.place] = rank
        size = int(rank.max(initial=-1)) + 1
        by_id = np.zeros(size, np.int64), np.zeros(size, np.int64)
        by_id[0][rank], by_id[1][rank] = start, length
        return cls(ranks, table, ids, arena, *by_id)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of each document, of which ``counts`` says how many ids it has."""
        length = self.length[ids]
        data = gather(self.arena, self.start[ids], length)
        border = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(counts)])]
        return pa.Array.from_buffers(
            pa.large_binary(), len(counts), [None, pa.py_buffer(border.astype(np.int64)), pa.py_buffer(data)]
        ).cast(pa.binary())


class PieceCache:
    """Ids of the pre-tokens that a worker merged before, by 64-bit hash; bounded."""

    def __init__(self, encode, limit: int = CACHE_PIECES):
        self.encode, self.limit = encode, limit
        self.kept: dict[int, bytes] = {}

    def ids(self, hashes: np.ndarray, piece) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their number for each hash; ``piece(i)`` gives the bytes."""
        kept, found, new = self.kept, [], []
        for i, h in enumerate(hashes.tolist()):
            ids = kept.get(h)
            if ids is None:
                new.append((i, h))
            found.append(ids)
        if new:
            coded = self.encode([piece(i) for i, _ in new])
            if len(kept) + len(new) > self.limit:
                for h in list(kept)[: len(kept) // 2 + 1]:
                    del kept[h]
            room = self.limit - len(kept)
            for k, ((i, h), ids) in enumerate(zip(new, coded, strict=True)):
                found[i] = ids
                if k < room:
                    kept[h] = ids
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.int32), lengths


def ids_of(pieces: Pieces, hashes: np.ndarray, known: np.ndarray, cache: PieceCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, and how many each has.  ``known``: the id, or -1 if not one token."""
    missed = np.flatnonzero(known < 0)
    length = np.ones(len(hashes), np.int64)
    distinct, where, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
    flat, lengths = cache.ids(distinct, lambda i: pieces.piece(missed[where[i]]))
    start = np.cumsum(lengths) - lengths
    length[missed] = lengths[back]
    # One run of values: merged pieces first, then the ids that were found whole.
    values = np.concatenate([flat, known.astype(np.int32)])
    source = len(flat) + np.arange(len(hashes))
    source[missed] = start[back]
    return gather(values, source, length), length


_states: dict[str, tuple] = {}


def _state(key: str, vocabulary) -> tuple[Vocabulary, PieceCache]:
    """The worker's own copy and cache; a worker lives through many tasks."""
    if key not in _states:
        v = vocabulary.value

        def encode(pieces: list[bytes]) -> list[bytes]:
            return [np.array(merge(p, v.ranks), np.int32).tobytes() for p in pieces]

        _states.clear()
        _states[key] = (v, PieceCache(encode))
    return _states[key]


def broadcast_vocabulary(spark: SparkSession, path: str):
    ranks = read_ranks(path)
    size = sum(len(t) + 64 for t in ranks)
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of {size} bytes is over the limit of {MAX_VOCABULARY_BYTES}")
    return spark.sparkContext.broadcast(Vocabulary.of(ranks))


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = False
) -> DataFrame:
    """``id_col`` and ``ids``, the token ids of every whole text, in their order.

    ``verify`` decodes the ids again in the same task and adds the bytes as ``decoded``.
    """
    shared = broadcast_vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, cache = _state(path, shared)
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(1)):
                pieces = Pieces(t)
                hashes = pieces.hashes()
                slots = v.table.find(hashes)
                known = np.where(slots >= 0, v.ids[slots], -1) if len(v.ids) else slots
                ids, length = ids_of(pieces, hashes, known, cache)
                total = np.concatenate([[0], np.cumsum(length)])[pieces.first]
                counts = np.diff(total)
                columns = [batch.column(0).slice(row, stop - row), tx.list_array(ids, counts, pa.int32())]
                if verify:
                    columns.append(v.decode(ids, counts))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "ids", "decoded"] if verify else [id_col, "ids"]
    read = docs.select(id_col, F.col(text_col).alias("_text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>" + ", decoded binary" * verify)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, the ids and ``decoded``, their bytes; no ids and null give no bytes."""
    shared = broadcast_vocabulary(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, _ = _state(path, shared)
        for batch in batches:
            lists = batch.column(1)
            counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            ids = np.asarray(lists.flatten(), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, v.decode(ids, counts)], [id_col, ids_col, "decoded"])

    read = encoded.select(id_col, ids_col)
    id_type = encoded.schema[id_col].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {id_type}, `{ids_col}` array<int>, decoded binary")
