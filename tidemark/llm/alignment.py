"""How the tokens of two tokenizers overlap, and how often each pair of ids does, corpus-wide.

1. A task encodes its documents with both tokenizers and cuts the bytes into groups where
   tokens of both end.  Every overlap of two tokens is a *link* of their ids.  The records
   (pair, document, links) of a bounded block of documents are sorted and radix-partitioned by the
   first id; each partition of a block becomes a *run*, compressed with zstd.  The head of a
   run has its pairs and how many documents of the block hold each, the body the documents.
2. For each radix partition the heads are merged by a heap, a bounded number at a time, which
   counts every pair.  The merge is in the order of the first id, so its highest
   count is known when its last pair has passed.  The counted pairs are one file a partition.
3. The runs pass once more, beside the counted pairs in the same order: what every pair contributes
   to the documents of its block streams back, and is added up by (block, place).

A head has one entry for a pair however many documents hold it, and bodies never leave their
block, so a pair that every document holds costs a task no more than any other.

Defined results: texts that are null, empty, or whose token bytes do not join to a space and the
text have no tokens and zeros throughout; special strings in texts are plain text; rows are documents
of their own, also if ids repeat or are null; no documents give no rows.  A text of any length is
taken whole.  Extra columns stay outside, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ship, store
from tidemark.llm import text as tx
from tidemark.llm.pieces import gather
from tidemark.llm.repair import Encoder

#: Radix partitions of the pairs, by their first id.
PARTS = 64
#: Links of a block of documents, at least one document; bounds a worker's memory.
BLOCK_LINKS = 6_000_000
#: Bits for the place of a document in its block.
_PLACE_BITS = 20
#: Runs that the heap merges at once.
FAN_IN = 128
SLICE_BYTES = 2 << 20


def _byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: bytes without a printable
    character of their own stand, in order, for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Flat:
    """Byte strings by number: the bytes one after the other, their starts and lengths."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def join(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.data, self.start[ids], self.length[ids])


class Tokenizers:
    """A worker's two tokenizers, and the bytes of their tokens."""

    def __init__(self, first: str, second: bytes):
        import sentencepiece

        self.first = Encoder(first)
        self.first.model.encode_special_tokens = True
        self.first.added = []  # their strings are plain text here
        spec = json.loads(first)
        values = _byte_values()
        entries = {i: s for s, i in spec["model"]["vocab"].items()}
        entries.update({a["id"]: a["content"] for a in spec.get("added_tokens") or ()})
        strings = [bytes(values.get(c, 0) for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        self.bytes_a = Flat(strings)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        self.bytes_b = Flat([self._piece(i) for i in range(self.second.get_piece_size())])
        # Ids as decimal digits with room for a separator.
        most = max(len(self.bytes_a.length), len(self.bytes_b.length))
        self.digits = Flat([b"%d," % i for i in range(most)])
        self.bits_a, self.bits_b = (int(len(f.length)).bit_length() for f in (self.bytes_a, self.bytes_b))
        if self.bits_a + self.bits_b + _PLACE_BITS > 62:
            raise ValueError("the vocabularies are too large for one number per record")

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: pa.Array) -> tuple[tx.Text, list[np.ndarray], list[np.ndarray]]:
        """The texts with a space before them, and the ids of both sides, flat and counted.

        Texts without tokens have none on either side.
        """
        texts = pc.fill_null(texts, "")
        spaced = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))
        data, offsets = tx.buffers(spaced)
        t = tx.Text(data, offsets)
        ids_a, counts_a = self.first.ids(t)
        coded = self.second.encode(texts.to_pylist(), num_threads=1)
        counts_b = np.array([len(c) for c in coded], np.int64)
        ids_b = np.fromiter((i for c in coded for i in c), np.int64, int(counts_b.sum()))
        sides = [[ids_a.astype(np.int64), counts_a], [ids_b, counts_b]]
        size = np.diff(offsets)
        valid = size > 1
        for (ids, counts), flat in zip(sides, (self.bytes_a, self.bytes_b), strict=True):
            valid &= self._joins(ids, counts, flat, t, size)
        for side in sides:
            side[0] = side[0][np.repeat(valid, side[1])]
            side[1] = np.where(valid, side[1], 0)
        return t, *sides

    @staticmethod
    def _joins(ids: np.ndarray, counts: np.ndarray, flat: Flat, t: tx.Text, size: np.ndarray) -> np.ndarray:
        """Whether the bytes of each document's tokens are those of its text."""
        border = np.concatenate([[0], np.cumsum(counts)])
        reach = np.concatenate([[0], np.cumsum(flat.length[ids])])[border]
        joined = flat.join(ids)
        if len(joined) == len(t.data) and np.array_equal(joined, t.data):
            return np.diff(reach) == size
        return np.array(
            [
                np.diff(reach)[i] == size[i] and np.array_equal(joined[reach[i] : reach[i + 1]], t.data[t.offsets[i] : t.offsets[i + 1]])
                for i in range(t.docs)
            ],
            bool,
        )


def _per_doc(flags: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    border = np.concatenate([[0], np.cumsum(counts)])
    return total[border[1:]] - total[border[:-1]]


class Aligned:
    """The links and groups of a few documents."""

    def __init__(self, models: Tokenizers, a: list[np.ndarray], b: list[np.ndarray]):
        (ids_a, self.n_a), (ids_b, self.n_b) = a, b
        end_a, end_b = np.cumsum(models.bytes_a.length[ids_a]), np.cumsum(models.bytes_b.length[ids_b])
        # Tokens without bytes cannot be: joined they are the text, and no entry is empty.
        meets = np.searchsorted(end_b, end_a)
        last_a = np.zeros(len(end_a), bool)
        inside = meets < len(end_b)
        last_a[inside] = end_b[meets[inside]] == end_a[inside]
        last_b = np.zeros(len(end_b), bool)
        last_b[meets[last_a]] = True
        self.n_groups = _per_doc(last_a, self.n_a)
        self.n_links = self.n_a + self.n_b - self.n_groups
        # Every piece between neighbouring ends, of whichever side, is one overlap.
        ends = np.concatenate([end_a, end_b[~last_b]])
        ends.sort(kind="stable")
        at_a = np.searchsorted(end_a, ends)
        self.pairs = (ids_a[at_a] << models.bits_b) | ids_b[np.searchsorted(end_b, ends)]
        self.doc = np.repeat(np.arange(len(self.n_a)), self.n_a)[at_a]
        self._text(models, ids_a, ids_b, last_a, last_b)

    def _text(self, models: Tokenizers, ids_a, ids_b, last_a, last_b) -> None:
        """The groups as text, all documents one after the other; each ends with one ``;``."""
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        n = len(ids_a) + len(ids_b)
        ids, separator = np.empty(n, np.int64), np.empty(n, np.uint8)
        at_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)
        at_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
        ids[at_a], ids[at_b] = ids_a, ids_b
        separator[at_a] = np.where(last_a, ord("|"), ord(","))
        separator[at_b] = np.where(last_b, ord(";"), ord(","))
        out = models.digits.join(ids)
        reach = np.cumsum(models.digits.length[ids])
        out[reach - 1] = separator
        border = np.concatenate([[0], reach])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])]
        raw = memoryview(out)
        self.sha256 = [
            hashlib.sha256(raw[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(border.tolist(), border[1:].tolist())
        ]


def radix(first: np.ndarray) -> np.ndarray:
    """The partition of each first id."""
    return (tx.mix_with(first.astype(np.uint64), 41) % np.uint64(PARTS)).astype(np.uint8)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


_HEAD, _BODY, _COUNTED = ("<i8", "<i8"), ("<u4", "<u4"), ("<i8", "<i8", "u1")


def runs(pairs: np.ndarray, place: np.ndarray, bits_b: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Partition, head and body of the runs of one block."""
    keys = (pairs << _PLACE_BITS) | place
    keys.sort()
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    links = np.diff(np.append(at, len(keys))).astype("<u4")
    keys = keys[at]
    pairs, place = keys >> _PLACE_BITS, (keys & ((1 << _PLACE_BITS) - 1)).astype("<u4")
    part = radix(pairs >> bits_b)
    order = np.argsort(part, kind="stable")
    pairs, place, links, part = pairs[order], place[order], links[order], part[order]
    border = np.searchsorted(part, np.arange(PARTS + 1))
    for p in range(PARTS):
        a, b = int(border[p]), int(border[p + 1])
        if a == b:
            continue
        own = pairs[a:b]
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        docs = np.diff(np.append(new, b - a))
        step = np.diff(place[a:b], prepend=np.uint32(0))
        step[new] = place[a:b][new]
        yield p, _packed(own[new].astype("<i8"), docs.astype("<i8")), _packed(step.astype("<u4"), links[a:b])


def merged(heads: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order and their counts, of at most :data:`FAN_IN` runs, merged by a heap."""
    streams = []
    for head in heads:
        pairs, docs = _unpacked(head, *_HEAD)
        streams.append(zip(pairs.tolist(), docs.tolist()))
    out_pairs, out_counts = [], []
    last = None
    for pair, docs in heapq.merge(*streams):
        if pair == last:
            out_counts[-1] += docs
        else:
            out_pairs.append(pair)
            out_counts.append(docs)
            last = pair
    return np.array(out_pairs, np.int64), np.array(out_counts, np.int64)


class Merger:
    """Merges any number of runs, :data:`FAN_IN` at a time: full levels become one run of the next."""

    def __init__(self):
        self.levels: list[list[bytes]] = [[]]

    def add(self, head: bytes) -> None:
        self.levels[0].append(head)
        level = 0
        while len(self.levels[level]) == FAN_IN:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(_packed(*merged(self.levels[level])))
            self.levels[level] = []
            level += 1

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        while sum(map(len, self.levels)) > FAN_IN:
            level = next(i for i, runs in enumerate(self.levels) if runs)
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(_packed(*merged(self.levels[level])))
            self.levels[level] = []
        return merged([head for level in self.levels for head in level])


def best_of_first(pairs: np.ndarray, counts: np.ndarray, bits_b: int) -> np.ndarray:
    """Whether each pair has the highest count of its first id; pairs are in order."""
    if not len(pairs):
        return np.zeros(0, bool)
    first = pairs >> bits_b
    start = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    most = np.maximum.reduceat(counts, start)
    return counts == np.repeat(most, np.diff(np.append(start, len(first))))


_models: dict[tuple[str, str], Tokenizers] = {}

_DOC = ("n_a", "n_b", "n_groups", "n_links")


def coded(docs: DataFrame, first: str, second: str, id_col: str, text_col: str) -> DataFrame:
    """Rows of two kinds: a document (``part`` is null) or a run of a block."""
    with open(first, encoding="utf-8") as a, open(second, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"part int, block long, place int, id {id_type}, " + "".join(f"{c} long, " for c in _DOC) + "groups_sha256 string, head binary, body binary"
    names = ["part", "block", "place", "id", *_DOC, "groups_sha256", "head", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (first, second) not in _models:
            _models.clear()
            _models[first, second] = Tokenizers(*shared.value)
        models = _models[first, second]
        block = TaskContext.get().partitionId() << 32
        pairs: list[np.ndarray] = []
        places: list[np.ndarray] = []
        links = held = 0
        kind = None

        def rows(n: int, **columns) -> pa.RecordBatch:
            kinds = {"part": pa.int32(), "block": pa.int64(), "place": pa.int32(), "id": kind, "groups_sha256": pa.string(), "head": pa.binary(), "body": pa.binary()}
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, kinds.get(k, pa.int64())) if c is not None else pa.nulls(n, kinds.get(k, pa.int64())) for k, c in ((k, columns.get(k)) for k in names)],
                names,
            )

        def close() -> Iterator[pa.RecordBatch]:
            if links:
                for part, head, body in runs(np.concatenate(pairs), np.concatenate(places), models.bits_b):
                    yield rows(1, part=[part], block=[block], head=[head], body=[body])

        for batch in batches:
            kind = batch.schema.field(1).type
            for row, stop in tx.slices(batch.column(0), SLICE_BYTES):
                _, a, b = models.encode(batch.column(0).slice(row, stop - row))
                found = Aligned(models, a, b)
                n = stop - row
                if held and (links + len(found.pairs) > BLOCK_LINKS or held + n >= 1 << _PLACE_BITS):
                    yield from close()
                    pairs, places, links, held, block = [], [], 0, 0, block + 1
                yield rows(
                    n, block=np.full(n, block), place=np.arange(held, held + n, dtype=np.int32), id=batch.column(1).slice(row, n),
                    n_a=found.n_a, n_b=found.n_b, n_groups=found.n_groups, n_links=found.n_links, groups_sha256=found.sha256,
                )
                pairs.append(found.pairs)
                places.append(found.doc + held)
                links += len(found.pairs)
                held += n
        yield from close()

    return docs.select(F.col(text_col).alias("_text"), F.col(id_col).alias("_id")).mapInArrow(run, schema)


def counted(heads: DataFrame, folder: str, bits_b: int) -> DataFrame:
    """``part`` and ``uri`` of the counted pairs of each partition, merged from the heads of all runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, merger = None, Merger()

        def close() -> pa.RecordBatch:
            pairs, counts = merger.finish()
            best = best_of_first(pairs, counts, bits_b)
            uri = store.write(folder, ".pairs", _packed(pairs.astype("<i8"), counts.astype("<i8"), best.astype("u1")))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "uri": [uri], "n_pairs": pa.array([len(pairs)], pa.int64())})

        for batch in batches:
            for own, head in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != part:
                    if part is not None:
                        yield close()
                    part, merger = own, Merger()
                merger.add(head)
        if part is not None:
            yield close()

    dealt = heads.select("part", "head").repartition(PARTS, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "part int, uri string, n_pairs long")


def contributions(bodies: DataFrame, uris: dict[int, str]) -> DataFrame:
    """``block``, ``place`` and what the links of each run add to a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pairs, counts, best = None, None, None, None
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for own, block, head, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != part:
                    part = own
                    pairs, counts, best = _unpacked(store.read(uris[part]), *_COUNTED)
                own_pairs, docs = _unpacked(head, *_HEAD)
                step, links = _unpacked(body, *_BODY)
                at = np.repeat(np.searchsorted(pairs, own_pairs), docs)
                # Places are steps from the one before, anew for each pair.
                total = np.cumsum(step.astype(np.int64))
                begin = np.cumsum(docs) - docs
                place = total - np.repeat(total[begin] - step[begin], docs)
                most = int(place.max()) + 1
                added = sums.get(block)
                if added is None or added.shape[1] < most:
                    grown = np.zeros((2, most), np.int64)
                    if added is not None:
                        grown[:, : added.shape[1]] = added
                    added = sums[block] = grown
                links = links.astype(np.int64)
                np.add.at(added[0], place, links * best[at])
                np.add.at(added[1], place, links * counts[at])
        for block, added in sums.items():
            n = added.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block), pa.int64()), pa.array(np.arange(n), pa.int32()), pa.array(added[0], pa.int64()), pa.array(added[1], pa.int64())],
                ["block", "place", "best", "total"],
            )

    read = bodies.select("part", "block", "head", "body").sortWithinPartitions("part")
    return read.mapInArrow(run, "block long, place int, best long, total long")


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment of every document between the byte-level vocabulary file ``first`` (A) and the
    piece model ``second`` (B): ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256``.
    """
    import sentencepiece

    spark = docs.sparkSession
    scratch = ship.Scratch(spark)
    bits_b = int(sentencepiece.SentencePieceProcessor(model_file=second).get_piece_size()).bit_length()
    rows = scratch.keep(coded(docs, first, second, id_col, text_col))
    runs_ = rows.where("part IS NOT NULL")
    # One row a partition.
    tables = scratch.keep(counted(runs_, f"{scratch.folder}/pairs", bits_b))
    uris = {r.part: r.uri for r in tables.collect()}
    added = contributions(runs_, uris).groupBy("block", "place").agg(F.sum("best").alias("best"), F.sum("total").alias("total"))
    joined = rows.where("part IS NULL").join(added, ["block", "place"], "left")
    return scratch.result(
        joined.select(
            F.col("id").alias(id_col), *_DOC,
            F.coalesce("best", F.lit(0).cast("long")).alias("n_best"), F.coalesce("total", F.lit(0).cast("long")).alias("count_sum"),
            "groups_sha256",
        )
    )
