"""Token-id shards under Re-Pair grammar compression, with random access.

The documents are range-partitioned by id, so that shards follow each other in ascending id
order.  A task encodes its texts, cuts the ids into shards of bounded size, and replaces
frequent pairs of ids by new symbols, round after round; the most frequent pairs of a
round are replaced together, from left to right.  A shard file keeps the rules, the
expansion length of every new symbol, and the document borders; to read some ids, the
running expansion lengths are searched and only the symbols around them are expanded.

File: ``RPR1``, header length (uint32), JSON header, then the little-endian arrays the header
names with their types.  Files are found by the manifest table alone.

Defined results: null and empty texts hold the end id only; a null id sorts first; equal ids
stay rows of their own.  Extra columns stay outside.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import ship, store
from tidemark.llm import text as tx
from tidemark.llm.bpe import PieceCache, ids_of
from tidemark.llm.pieces import Pieces, gather

MAGIC = b"RPR1"
#: Ids in a shard, at least one document.
SHARD_IDS = 1 << 20
ROUNDS = 5
PAIRS_PER_ROUND = 1_000
LEAST_COUNT = 24
_BINS = 1 << 18
#: Pieces a worker remembers the ids of.
CACHE_PIECES = 400_000
PIECES_PER_CALL = 256
SLICE_BYTES = 2 << 20


def _bins(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)
    return mixed >> np.uint32(14)


def compress(ids: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols, and the rules (two symbols each) of the new ones from ``terminals`` on."""
    symbols = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    made = 0
    for _ in range(ROUNDS):
        if len(symbols) < 2:
            break
        left, right = symbols[:-1], symbols[1:]
        bins = _bins(left, right)
        heavy = np.bincount(bins, minlength=_BINS)
        least = max(LEAST_COUNT, int(np.partition(heavy, -PAIRS_PER_ROUND)[-PAIRS_PER_ROUND]))
        at = np.flatnonzero((heavy >= least)[bins])
        if not len(at):
            break
        # One pair stands for its bin; foreign pairs of the bin are left alone.
        own = bins[at]
        pairs = (left[at].astype(np.uint64) << np.uint64(32)) | right[at]
        standing = np.zeros(_BINS, np.uint64)
        standing[own] = pairs
        fits = pairs == standing[own]
        at, own = at[fits], own[fits]
        # Of overlapping pairs every second one is replaced, from the left.
        index = np.arange(len(at))
        begins = np.ones(len(at), bool)
        begins[1:] = np.diff(at) != 1
        free = (index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0
        at, own = at[free], own[free]
        used = np.bincount(own, minlength=_BINS)
        chosen = np.flatnonzero(used >= 2)
        if not len(chosen):
            break
        number = np.full(_BINS, -1, np.int64)
        number[chosen] = np.arange(len(chosen))
        worth = number[own] >= 0
        at, own = at[worth], own[worth]
        rules.append(np.stack([standing[chosen] >> np.uint64(32), standing[chosen] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        symbols[at] = (terminals + made + number[own]).astype(np.uint32)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols = symbols[keep]
        made += len(chosen)
    return symbols, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """How many ids each rule stands for; a rule refers to earlier ones only."""
    lengths = np.ones(len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[i] = (lengths[a - terminals] if a >= terminals else 1) + (lengths[b - terminals] if b >= terminals else 1)
    return lengths


class Grammar:
    """Expands symbols by the rules of one shard."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, terminals: int):
        self.terminals, self.lengths = terminals, lengths
        self.start = np.cumsum(lengths) - lengths
        self.arena = np.zeros(int(lengths.sum()), np.uint32)
        for i, pair in enumerate(rules.tolist()):
            at = self.start[i]
            for symbol in pair:
                if symbol < terminals:
                    self.arena[at] = symbol
                    at += 1
                else:
                    k = symbol - terminals
                    self.arena[at : at + lengths[k]] = self.arena[self.start[k] : self.start[k] + lengths[k]]
                    at += lengths[k]

    def lengths_of(self, symbols: np.ndarray) -> np.ndarray:
        if not len(self.lengths):
            return np.ones(len(symbols), np.int64)
        new = symbols >= self.terminals
        return np.where(new, self.lengths[np.where(new, symbols - self.terminals, 0)], 1)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.int64)
        lengths = self.lengths_of(symbols)
        new = symbols >= self.terminals
        values = np.concatenate([self.arena, symbols[~new].astype(np.uint32)])
        start = np.empty(len(symbols), np.int64)
        start[new] = self.start[symbols[new] - self.terminals]
        start[~new] = len(self.arena) + np.arange(int((~new).sum()))
        return gather(values, start, lengths)


def pack(ids: np.ndarray, counts: np.ndarray, doc_ids: list, terminals: int) -> bytes:
    """The bytes of a shard file."""
    symbols, rules = compress(ids, terminals)
    alphabet, codes = np.unique(symbols, return_inverse=True)
    lengths = expansion_lengths(rules, terminals)
    arrays = {
        "counts": counts.astype("<u4"),
        "rules": rules.astype("<u4"),
        "lengths": lengths.astype("<u4"),
        "alphabet": alphabet.astype("<u4"),
        "codes": codes.astype("<u2" if len(alphabet) <= 1 << 16 else "<u4"),
    }
    header = json.dumps(
        {"terminals": terminals, "docs": doc_ids, "arrays": [[n, a.dtype.str, a.size] for n, a in arrays.items()]}
    ).encode()
    return MAGIC + struct.pack("<I", len(header)) + header + b"".join(a.tobytes() for a in arrays.values())


class Shard:
    """An opened shard file."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard file")
        (size,) = struct.unpack("<I", data[4:8])
        header = json.loads(data[8 : 8 + size])
        at, arrays = 8 + size, {}
        for name, kind, n in header["arrays"]:
            arrays[name] = np.frombuffer(data, np.dtype(kind), n, at)
            at += arrays[name].nbytes
        self.docs = header["docs"]
        self.counts = arrays["counts"].astype(np.int64)
        self.border = np.concatenate([[0], np.cumsum(self.counts)])
        self.symbols = arrays["alphabet"][arrays["codes"]]
        self.grammar = Grammar(arrays["rules"].reshape(-1, 2), arrays["lengths"].astype(np.int64), header["terminals"])
        self._reach = None

    def ids(self) -> np.ndarray:
        return self.grammar.expand(self.symbols)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only the symbols around them are expanded."""
        if self._reach is None:
            self._reach = np.cumsum(self.grammar.lengths_of(self.symbols.astype(np.int64)))
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(self._reach, start, "right"))
        last = int(np.searchsorted(self._reach, stop - 1, "right")) + 1
        before = int(self._reach[first - 1]) if first else 0
        return self.grammar.expand(self.symbols[first:last])[start - before : stop - before]

    def document(self, i: int) -> np.ndarray:
        return self.read(int(self.border[i]), int(self.border[i + 1]))


class Encoder:
    """A worker's tokenizer; every distinct piece goes through the library once per slice."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.model = tokenizers.Tokenizer.from_str(content)
        self.model.no_truncation()
        self.model.no_padding()
        self.added = [a["content"].encode() for a in json.loads(content).get("added_tokens") or ()]
        self.cache = PieceCache(lambda pieces: self._pieces([p.decode("utf-8") for p in pieces]), CACHE_PIECES)
        line_break = self.model.encode("\n", add_special_tokens=False).ids
        self.line_break = line_break[0] if len(line_break) == 1 else None

    def _library(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        return [array("i", e.ids).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, many in one call: a line break is a piece of its own between any two
        pieces that are not white space, so it cuts their ids apart again."""
        if self.line_break is None:
            return self._library(pieces)
        solid = [i for i, p in enumerate(pieces) if not p.isspace()]
        groups = [solid[at : at + PIECES_PER_CALL] for at in range(0, len(solid), PIECES_PER_CALL)]
        out: list[bytes | None] = [None] * len(pieces)
        joined = ["\n".join([pieces[i] for i in group]) for group in groups]
        for group, coded in zip(groups, self.model.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(coded.ids, np.int32)
            cuts = np.flatnonzero(ids == self.line_break)
            if len(cuts) != len(group) - 1:
                continue
            data = ids.tobytes()
            begin = [0, *(4 * cuts + 4).tolist()]
            end = [*(4 * cuts).tolist(), len(data)]
            for i, a, b in zip(group, begin, end, strict=True):
                out[i] = data[a:b]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._library([pieces[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def ids(self, t: tx.Text) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of each document."""
        pieces = Pieces(t)
        hashes = pieces.hashes()
        flat, length = ids_of(pieces, hashes, np.full(len(hashes), -1), self.cache)
        counts = np.diff(np.concatenate([[0], np.cumsum(length)])[pieces.first])
        data = t.data.tobytes()
        if not any(a in data for a in self.added):
            return flat, counts
        # The library gives an added string in a text an id of its own.
        border = np.concatenate([[0], np.cumsum(counts)])
        parts = [flat[border[i] : border[i + 1]] for i in range(t.docs)]
        for i in range(t.docs):
            own = data[t.offsets[i] : t.offsets[i + 1]]
            if any(a in own for a in self.added):
                parts[i] = np.frombuffer(self._library([own.decode("utf-8")])[0], np.int32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


_encoders: dict[str, Encoder] = {}


def write_shards(
    docs: DataFrame, path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and write all documents; the manifest: ``part``, ``shard``, ``uri``, ``n_docs``, ``n_ids``."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    spec = json.loads(content)
    terminals = 1 + max([end_id, *spec["model"]["vocab"].values(), *(a["id"] for a in spec.get("added_tokens") or ())])
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders.clear()
            _encoders[path] = Encoder(shared.value)
        encoder = _encoders[path]
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        counts: list[int] = []
        names: list = []
        size = shard = 0

        def close() -> pa.RecordBatch:
            data = pack(np.concatenate(held), np.array(counts), names, terminals)
            row = {
                "part": [part], "shard": [shard], "uri": [store.write(folder, ".rpr", data)],
                "n_docs": [len(counts)], "n_ids": [size], "n_bytes": [len(data)],
            }
            return pa.RecordBatch.from_pydict(row, schema=schema)

        schema = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, _, t in tx.texts(batch.column(1), limit=SLICE_BYTES):
                flat, n = encoder.ids(t)
                border = np.concatenate([[0], np.cumsum(n)])
                # Each document with its end id.
                whole = np.empty(len(flat) + t.docs, np.int32)
                ends = border[1:] + np.arange(t.docs)
                inner = np.ones(len(whole), bool)
                inner[ends] = False
                whole[inner] = flat
                whole[ends] = end_id
                held.append(whole)
                counts.extend((n + 1).tolist())
                names.extend(ids[row : row + t.docs])
                size += len(whole)
                if size >= SHARD_IDS:
                    yield close()
                    held, counts, names, size, shard = [], [], [], 0, shard + 1
        if counts:
            yield close()

    ordered = docs.select(id_col, F.col(text_col).alias("_text")).repartitionByRange(id_col).sortWithinPartitions(id_col)
    return session.checkpointed(
        ordered.mapInArrow(run, "part long, shard long, uri string, n_docs long, n_ids long, n_bytes long")
    )


def read_documents(spark: SparkSession, manifest: DataFrame, id_type: str = "long", id_col: str = "doc_id") -> DataFrame:
    """All documents of the files: id, ``start`` (ids before it), ``n_tokens`` and ``ids_crc32``."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("_own"))
    before = parts.select("part", (F.sum("_own").over(Window.orderBy("part")) - F.col("_own")).alias("_before"))
    inside = Window.partitionBy("part").orderBy("shard")
    placed = manifest.join(before, "part").select(
        "uri", (F.col("_before") + F.sum("n_ids").over(inside) - F.col("n_ids")).alias("base")
    )
    files = session.checkpointed(placed)
    count = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(store.read(uri))
                ids = memoryview(shard.ids().astype("<u4").tobytes())
                border = (4 * shard.border).tolist()
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(border, border[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.docs, pa.int64()), pa.array(base + shard.border[:-1], pa.int64()),
                        pa.array(shard.counts, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    [id_col, "start", "n_tokens", "ids_crc32"],
                )

    return files.repartition(max(2, min(count, 1000 + count // 100))).mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long"
    )


def encode_and_read(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shard files to the shared folder, then read them back."""
    spark = docs.sparkSession
    folder = ship.folder(spark, "ids")
    return read_documents(spark, write_shards(docs, path, end_id, folder, id_col, text_col), id_col=id_col)
