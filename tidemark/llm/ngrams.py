"""Language-model scores from an Elias-Fano n-gram trie in memory-mapped files.

The first level is the vocabulary: the sorted hashes of all training words with their counts;
a word's id is its rank.  The second level holds, for each context word, the words that
follow it.  Contexts and (context, follower) pairs are monotone number sequences under Elias
and Fano's code; a follower is found by a successor search from the base of its context.
Each pair has its smoothed probability, quantised to one of 256 evenly spaced logarithms of its shard.

    P(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    P(w | v) = (c(v, w) + M P(w)) / (c(v) + M)

with the counts of the pairs that were seen ``least_pair`` times or more; a pair without an
entry has c(v, w) = 0.  With 1 every pair counts, and c(v) is the count of v in the corpus;
``train`` takes 2 unless it is told otherwise.  Counting covers every training text.  Levels are written to the
shared folder in shards, and scoring maps them, so a worker's memory does not grow with
the model and no text is shuffled.

Defined results: words are A-Z lower-cased; every text ends with an end token, so null and
empty texts have one token; rows are scored one by one, whether ids repeat or are null; with
nothing to learn from every word is unknown.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import ship, store
from tidemark.llm import text as tx

#: Weight of the lower level in a smoothed probability.
PRIOR = 50.0
#: ``least_pair`` of the bound query: every pair that was seen has an entry.
LEAST_PAIR = 1
#: Training tokens whose pairs make one shard, and pairs a task counts before it hands them on.
SHARD_TOKENS = 4_000_000
HELD_PAIRS = 3_000_000
SLICE_BYTES = 4 << 20
_END = np.int64(tx.span_hashes(tx._BYTE_VALUES[np.array([10], np.uint8)], np.array([0]), np.array([1])).view(np.int64)[0])


class EliasFano:
    """A sorted sequence of distinct numbers: low bits packed, high bits in unary.

    Every number ends its run of zeros with a one in ``high``; a bucket is what shares
    the high bits, and it starts behind as many zeros.
    """

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (universe // max(1, n)).bit_length() - 1)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 1
        bits = np.zeros(-(-size // 64) * 64, bool)
        bits[high + np.arange(n)] = True
        words = np.packbits(bits, bitorder="little").view("<u8")
        zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))]).astype("<u4")
        low = (values & np.uint64((1 << low_bits) - 1)).astype(np.uint64)
        stream = np.zeros(-(-n * low_bits // 64) + 2, np.uint64)
        at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(stream, word, low << shift)
        over = np.flatnonzero(shift + np.uint64(low_bits) > 64)
        np.bitwise_or.at(stream, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        head = struct.pack("<QQQQ", n, low_bits, len(words), len(stream))
        pad = b"\0" * (-4 * len(zeros) % 8)
        return head + words.tobytes() + zeros.tobytes() + pad + stream.astype("<u8").tobytes()

    def __init__(self, data: np.ndarray, at: int = 0):
        self.n, self.low_bits, words, stream = struct.unpack("<QQQQ", data[at : at + 32].tobytes())
        at += 32
        self.words = data[at : at + 8 * words].view("<u8")
        at += 8 * words
        self.zeros = data[at : at + 4 * (words + 1)].view("<u4")
        at += 4 * (words + 1) + (-4 * (words + 1) % 8)
        self.stream = data[at : at + 8 * stream].view("<u8")
        self.end = at + 8 * stream
        self.mask = np.uint64((1 << self.low_bits) - 1)

    def low(self, index: np.ndarray) -> np.ndarray:
        at = index.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        first = self.stream[word] >> shift
        second = np.where(shift > 0, self.stream[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (first | second) & self.mask

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Bit position of zero number ``k``, counted from 0."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        rest = k - self.zeros[word]
        free = ~self.words[word]
        at = np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            lower = np.bitwise_count((free >> at.astype(np.uint64)) & np.uint64((1 << step) - 1)).astype(np.int64)
            beyond = rest >= lower
            rest = np.where(beyond, rest - lower, rest)
            at += np.where(beyond, step, 0)
        return 64 * word + at

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value in the sequence, -1 if it is not there."""
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        inside = np.flatnonzero(high < int(self.zeros[-1]))
        high, low = high[inside], values[inside] & self.mask
        # The bucket lies between two zeros; places before it are ones.
        begin = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - high + 1, 0)
        end = self._zero(high) - high
        # A frequent context fills its buckets, so each bucket is searched by halves.
        at, stop = begin.copy(), end.copy()
        live = np.flatnonzero(at < stop)
        while len(live):
            middle = (at[live] + stop[live]) >> 1
            less = self.low(middle) < low[live]
            at[live[less]] = middle[less] + 1
            stop[live[~less]] = middle[~less]
            live = live[at[live] < stop[live]]
        held = np.flatnonzero(at < end)
        hit = held[self.low(at[held]) == low[held]]
        out[inside[hit]] = at[hit]
        return out


class Vocabulary:
    """The mapped first level: ids and counts of words by hash."""

    def __init__(self, parts: list[tuple[int, str, int]]):
        self.first = np.array([p[0] for p in parts], np.int64)
        self.base = np.concatenate([[0], np.cumsum([p[2] for p in parts])]).astype(np.int64)
        self.hashes, self.counts = [], []
        for _, uri, n in parts:
            data = store.mapped(uri)
            self.hashes.append(data[: 8 * n].view("<i8"))
            self.counts.append(data[8 * n : 16 * n].view("<i8"))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1: unknown) and count of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        part = np.searchsorted(self.first, hashes, "right") - 1
        border = np.searchsorted(part, np.arange(len(self.first) + 1))
        for p in np.flatnonzero(np.diff(border)).tolist():
            own = slice(border[p], border[p + 1])
            table = self.hashes[p]
            at = np.minimum(np.searchsorted(table, hashes[own]), len(table) - 1)
            hit = table[at] == hashes[own]
            ids[own] = np.where(hit, self.base[p] + at, -1)
            counts[own] = np.where(hit, self.counts[p][at], 0)
        return ids, counts

    def count_of(self, ids: np.ndarray) -> np.ndarray:
        """Counts of sorted ids."""
        out = np.zeros(len(ids), np.int64)
        border = np.searchsorted(ids, self.base)
        for p in np.flatnonzero(np.diff(border)).tolist():
            own = slice(border[p], border[p + 1])
            out[own] = self.counts[p][ids[own] - self.base[p]]
        return out


def _shard_of(contexts: np.ndarray, shards: int) -> np.ndarray:
    return (tx.mix_with(contexts.astype(np.uint64), 41) % np.uint64(shards)).astype(np.int64)


class Shard:
    """The mapped followers of a part of the contexts."""

    def __init__(self, uri: str):
        data = store.mapped(uri)
        (size,) = struct.unpack("<Q", data[:8].tobytes())
        header = json.loads(data[8 : 8 + size].tobytes())
        at = 8 + size
        self.contexts = EliasFano(data, at)
        self.pairs = EliasFano(data, self.contexts.end)
        n, m = header["contexts"], header["pairs"]
        at = self.pairs.end
        self.totals = data[at : at + 8 * n].view("<i8")
        at += 8 * n
        self.book = data[at : at + 4 * 256].view("<f4")
        at += 4 * 256
        self.grades = data[at : at + m]

    @staticmethod
    def pack(contexts: np.ndarray, totals: np.ndarray, pairs: np.ndarray, logs: np.ndarray) -> bytes:
        book = np.linspace(logs.min(), logs.max(), 256).astype("<f4") if len(logs) else np.zeros(256, "<f4")
        edges = (book[1:] + book[:-1]) / 2
        grades = np.searchsorted(edges, logs).astype(np.uint8)
        header = json.dumps({"contexts": len(contexts), "pairs": len(pairs)}).encode()
        header += b" " * (-len(header) % 8)
        return b"".join(
            [
                struct.pack("<Q", len(header)), header,
                EliasFano.pack(contexts.astype(np.uint64)), EliasFano.pack(pairs.astype(np.uint64)),
                totals.astype("<i8").tobytes(), book.tobytes(), grades.tobytes(),
            ]
        )


@dataclass
class Model:
    """What scoring needs to know: small numbers and the names of the files."""

    tokens: int
    words: int
    parts: list[tuple[int, str, int]]
    shards: list[str | None]

    def low(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.words + 1))


class Opened:
    """A model in a worker."""

    def __init__(self, model: Model):
        self.model = model
        self.vocabulary = Vocabulary(model.parts)
        self.shards: dict[int, Shard] = {}

    def tokens(self, t: tx.Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id and count of each token, ends included, and the number of each document."""
        hashes, lengths = with_ends(t)
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts = self.vocabulary.find(distinct)
        return ids[back], counts[back], lengths

    def pair_logs(self, contexts: np.ndarray, followers: np.ndarray, low: np.ndarray) -> np.ndarray:
        """log10 P(follower | context) of known contexts; unknown followers are -1."""
        out = np.zeros(len(contexts))
        if not self.model.shards:
            return np.log10(low)
        shard = _shard_of(contexts, len(self.model.shards))
        order = np.argsort(shard, kind="stable")
        border = np.searchsorted(shard[order], np.arange(len(self.model.shards) + 1))
        for s in np.flatnonzero(np.diff(border)).tolist():
            own = order[border[s] : border[s + 1]]
            if self.model.shards[s] is None:
                out[own] = np.log10(low[own])
                continue
            if s not in self.shards:
                self.shards[s] = Shard(self.model.shards[s])
            table = self.shards[s]
            known, which = np.unique(contexts[own], return_inverse=True)
            place = table.contexts.find(known.astype(np.uint64))
            total = np.where(place >= 0, table.totals[np.maximum(place, 0)], 0)[which]
            logs = np.log10(PRIOR * low[own] / (total + PRIOR))
            ask = np.flatnonzero((total > 0) & (followers[own] >= 0))
            code = contexts[own][ask].astype(np.uint64) * np.uint64(self.model.words) + followers[own][ask].astype(np.uint64)
            distinct, back = np.unique(code, return_inverse=True)
            at = table.pairs.find(distinct)[back]
            hit = at >= 0
            logs[ask[hit]] = table.book[table.grades[at[hit]]]
            out[own] = logs
        return out

    def score(self, t: tx.Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, base score and model score of each document."""
        ids, counts, lengths = self.tokens(t)
        low = self.model.low(counts)
        base = np.log10(low)
        inner = np.ones(len(ids), bool)
        border = np.concatenate([[0], np.cumsum(lengths)])
        inner[border[:-1]] = False
        later = np.flatnonzero(inner)
        later = later[ids[later - 1] >= 0]
        logs = base.copy()
        logs[later] = self.pair_logs(ids[later - 1], ids[later], low[later])

        def summed(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, border[:-1]) if len(values) else np.zeros(0)

        return lengths, summed((counts > 0).astype(np.int64)), summed(base), summed(logs)


def with_ends(t: tx.Text) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end token behind every document, and the tokens of each."""
    lengths = t.words_per_doc() + 1
    out = np.empty(int(lengths.sum()), np.int64)
    ends = np.cumsum(lengths) - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = t.word_hashes().view(np.int64)
    out[ends] = _END
    return out, lengths


def _vocabulary(texts: DataFrame, folder: str) -> tuple[int, int, list[tuple[int, str, int]]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, t in tx.texts(batch.column(0), lower=True, limit=SLICE_BYTES):
                hashes, n = np.unique(with_ends(t)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n, pa.int64())], ["hash", "n"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches if b.num_rows]
        if not got:
            return
        hashes, n = (np.concatenate(c) for c in zip(*got, strict=True))
        uri = store.write(folder, ".words", hashes.astype("<i8").tobytes() + n.astype("<i8").tobytes())
        row = {"first": [int(hashes[0])], "uri": [uri], "words": [len(hashes)], "tokens": [int(n.sum())]}
        yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("first", pa.int64()), ("uri", pa.string()), ("words", pa.int64()), ("tokens", pa.int64())]))

    counted = texts.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    parts = session.checkpointed(
        counted.repartitionByRange("hash").sortWithinPartitions("hash").mapInArrow(write, "first long, uri string, words long, tokens long")
    ).orderBy("first").collect()
    return sum(r.tokens for r in parts), sum(r.words for r in parts), [(r.first, r.uri, r.words) for r in parts]


def _packed(codes: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted codes and counts, byte plane by byte plane."""
    steps = np.diff(codes, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + n.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = len(planes) // 12
    steps = np.ascontiguousarray(planes[: 8 * size].reshape(8, size).T).reshape(-1).view("<u8")
    n = np.ascontiguousarray(planes[8 * size :].reshape(4, size).T).reshape(-1).view("<u4")
    return np.cumsum(steps, dtype=np.uint64), n.astype(np.int64)


def _counted(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def _followers(texts: DataFrame, model: Model, shards: int, folder: str, least_pair: int) -> list[str | None]:
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Opened(shared.value)
        words = np.uint64(model.words)
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            shard = _shard_of(codes // words, shards)
            order = np.argsort(shard, kind="stable")
            border = np.searchsorted(shard[order], np.arange(shards + 1))
            full = np.flatnonzero(np.diff(border)).tolist()
            data = [_packed(codes[order[border[s] : border[s + 1]]], n[order[border[s] : border[s + 1]]]) for s in full]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(data, pa.binary())], ["shard", "data"])

        for batch in batches:
            for _, _, t in tx.texts(batch.column(0), lower=True, limit=SLICE_BYTES):
                ids, _, lengths = opened.tokens(t)
                inner = np.ones(len(ids), bool)
                inner[np.cumsum(lengths) - lengths] = False
                later = np.flatnonzero(inner)
                held.append(ids[later - 1].astype(np.uint64) * words + ids[later].astype(np.uint64))
                size += len(later)
                if size >= HELD_PAIRS:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Opened(shared.value)
        now, held = None, []

        def close() -> pa.RecordBatch:
            codes, n = _counted(*(np.concatenate(c) for c in zip(*held, strict=True)))
            codes, n = codes[n >= least_pair], n[n >= least_pair]
            context = (codes // np.uint64(model.words)).astype(np.int64)
            follower = (codes % np.uint64(model.words)).astype(np.int64)
            contexts, which = np.unique(context, return_inverse=True)
            totals = np.bincount(which, n, len(contexts)).astype(np.int64)
            asked, back = np.unique(follower, return_inverse=True)
            low = model.low(opened.vocabulary.count_of(asked))[back]
            logs = np.log10((n + PRIOR * low) / (totals[which] + PRIOR))
            uri = store.write(folder, ".pairs", Shard.pack(contexts, totals, codes, logs))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([uri], pa.string())], ["shard", "uri"])

        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard != now and held:
                    yield close()
                    held = []
                now = shard
                held.append(_unpacked(data))
                if sum(len(h[0]) for h in held[1:]) > HELD_PAIRS:
                    held = [_counted(*(np.concatenate(c) for c in zip(*held, strict=True)))]
        if held:
            yield close()

    counted = texts.mapInArrow(count, "shard long, data binary").repartition(shards, "shard").sortWithinPartitions("shard")
    written = session.checkpointed(counted.mapInArrow(build, "shard long, uri string")).collect()
    uris: list[str | None] = [None] * shards
    for r in written:
        uris[r.shard] = r.uri
    return uris


def train(docs: DataFrame, learn: Column, text_col: str = "text", least_pair: int = 1) -> Model:
    """A model of all texts for which ``learn`` holds; its files are in the shared folder.

    Pairs seen less than ``least_pair`` times are left out, also of c(v); 1 leaves none out.
    """
    spark = docs.sparkSession
    folder = ship.folder(spark, "ngrams")
    texts = docs.where(learn).select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    tokens, words, parts = _vocabulary(texts, folder)
    model = Model(tokens, words, parts, [])
    if tokens:
        model.shards = _followers(texts, model, 1 + tokens // SHARD_TOKENS, folder, least_pair)
    return model


_opened: dict[str, Opened] = {}


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = model.parts[0][1] if model.parts else ""
    names = [id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _opened:
            _opened.clear()
            _opened[key] = Opened(shared.value)
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(1), lower=True, limit=SLICE_BYTES):
                n, known, base, logs = _opened[key].score(t)
                columns = [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(t.docs, model.tokens), pa.int64()), pa.array(base), pa.array(logs)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, stop - row), *columns], names)

    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(id_col, F.col(text_col).alias("_text"))
    return read.mapInArrow(run, f"`{id_col}` {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
