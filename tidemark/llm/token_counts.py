"""Token counts per document without a shuffle of texts or pre-tokens.

Tier one is a compact hash table of the lengths of frequent pre-tokens, broadcast.  Every task counts
the pre-tokens of its documents and sends its most frequent ones, a few thousand; the most
frequent of these fill the table.  Tier two encodes the pre-tokens it lacks with
the tokenizer itself, each distinct one once, behind a bounded cache of the worker.

The pre-tokens are those of a word vocabulary: normalised to NFC, white space folded,
lower-cased, then split by ``'s|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+``.

Defined results: null and empty texts have no tokens and no bytes.  A text that holds one of
the vocabulary's added strings, or a character whose case or composition depends on what
surrounds it, is encoded whole by the library; so is everything with a vocabulary
of another kind.  Pre-tokens are told apart by 64-bit hashes.  Texts of any length are taken
whole; rows of equal id are rows of their own; extra columns stay outside, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.pieces import ENDINGS, LETTER, NUMBER, SPACE, UNKNOWN, classes

#: Slots of the table of frequent pre-tokens; half of them are filled.
SLOTS = 1 << 16
#: Pre-tokens that a task counts at once (the rarer half goes when there are more), and that it sends.
#: Both bound memory and change hit rates alone: what the table lacks is encoded.
HELD, SENT = 1 << 18, 4_096
#: Slots of the worker's cache of other pre-tokens; a slot keeps the latest.
CACHE_SLOTS = 1 << 20
_PLAIN, _WHOLE = 1, 2


class Lengths:
    """Pre-token lengths by hash; a slot holds one key, and a later key replaces it."""

    def __init__(self, slots: int):
        self.mask = np.uint64(slots - 1)
        self.key = np.zeros(slots, np.uint64)
        self.length = np.full(slots, -1, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & self.mask).astype(np.int64)
        return np.where(self.key[at] == hashes, self.length[at], -1)

    def put(self, hashes: np.ndarray, lengths: np.ndarray) -> None:
        at = (hashes & self.mask).astype(np.int64)
        self.key[at] = hashes
        # Of several new keys for a slot one wins; its length must be the one that stays.
        won = self.key[at] == hashes
        self.length[at[won]] = lengths[won]


class Folding:
    """How each character normalises by itself, found when it first occurs.

    ``_PLAIN`` characters become one character whatever surrounds them.  The others make
    the library encode their text whole.
    """

    def __init__(self):
        self.kind = np.full(0x110000, UNKNOWN, np.uint8)
        self.to = np.zeros(0x110000, np.uint32)

    def learn(self, points: np.ndarray) -> None:
        for point in np.unique(points[self.kind[points] == UNKNOWN]).tolist():
            char = chr(point)
            lower = char.lower()
            safe = (
                unicodedata.category(char)[0] not in "MCo"
                or point in (9, 10, 11, 12, 13)
            ) and len(lower) == 1 and unicodedata.normalize("NFC", char) == char and char not in "Σİ" and not (0x1100 <= point <= 0x11FF)
            self.kind[point] = _PLAIN if safe else _WHOLE
            self.to[point] = ord(lower) if len(lower) == 1 else point


@lru_cache(maxsize=1)
def folding() -> Folding:
    return Folding()


class WordPieces:
    """Pre-tokens of a few documents: their hashes, their text and how many each document has."""

    def __init__(self, t: tx.Text):
        text = t.data.tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.append(np.flatnonzero((t.data & 0xC0) != 0x80), len(t.data))
        first = np.searchsorted(at, t.offsets)
        fold = folding()
        if (fold.kind[points] == UNKNOWN).any():
            fold.learn(points)
        odd = fold.kind[points] == _WHOLE
        total = np.concatenate([[0], np.cumsum(odd)])
        #: Documents that only the library can encode.
        self.whole = total[first[1:]] > total[first[:-1]]
        n = len(points)
        self.points = points = fold.to[points]
        kind = classes()(points)
        edge = np.zeros(n + 1, bool)
        edge[first] = True
        start = edge[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        start |= kind == NUMBER
        for mark in np.flatnonzero(start & (points == 39)).tolist():
            for ending in ENDINGS:
                stop = mark + 1 + len(ending)
                if stop <= n and not edge[mark + 1 : stop].any() and all(points[mark + 1 + k] == ord(c) for k, c in enumerate(ending)):
                    start[mark + 1] = False
                    if stop < n:
                        start[stop] = True
                    break
        begins = np.flatnonzero(start)
        ends = np.append(begins[1:], n) if len(begins) else begins
        words = kind[begins] != SPACE
        self.begin, self.end = begins[words], ends[words]
        self.first = np.searchsorted(self.begin, first)

    def hashes(self) -> np.ndarray:
        return tx.span_hashes(tx.mix_with(self.points.astype(np.uint64), 31), self.begin, self.end)

    def piece(self, i: int) -> str:
        return self.points[self.begin[i] : self.end[i]].tobytes().decode("utf-32-le")


@dataclass
class Tokenizer:
    """A tokenizer file: its text for the workers, its added strings, whether it splits by words."""

    name: str
    content: bytes
    added: tuple[str, ...]
    by_words: bool

    @classmethod
    def read(cls, path: str) -> Tokenizer:
        with open(path, "rb") as file:
            content = file.read()
        if not path.endswith(".json"):
            return cls(path, content, (), False)
        spec = json.loads(content)
        added = tuple(a["content"] for a in spec.get("added_tokens") or ())
        by_words = spec["model"].get("end_of_word_suffix") == "</w>" and "Lowercase" in json.dumps(spec.get("normalizer"))
        return cls(path, content, added, by_words)

    def counter(self):
        """A function from texts to their numbers of tokens, by the library."""
        if self.name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.content)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        model = tokenizers.Tokenizer.from_str(self.content.decode())
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]


class Counter:
    """A worker's two tiers."""

    def __init__(self, tokenizer: Tokenizer, frequent: Lengths):
        self.count = tokenizer.counter()
        self.by_words = tokenizer.by_words
        self.frequent, self.cache = frequent, Lengths(CACHE_SLOTS)
        self.added = [a.encode() for a in tokenizer.added]

    def of(self, t: tx.Text) -> np.ndarray:
        whole = np.ones(t.docs, bool)
        tokens = np.zeros(t.docs, np.int64)
        if self.by_words:
            pieces = WordPieces(t)
            whole = pieces.whole | self._with_added(t)
            hashes = pieces.hashes()
            lengths = self.frequent.find(hashes)
            missed = np.flatnonzero(lengths < 0)
            if len(missed):
                cached = self.cache.find(hashes[missed])
                lengths[missed] = cached
                missed = missed[cached < 0]
            if len(missed):
                distinct, where, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
                counted = np.array(self.count([pieces.piece(i) for i in missed[where].tolist()]), np.int32)
                self.cache.put(distinct, counted)
                lengths[missed] = counted[back]
            total = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            tokens = total[pieces.first[1:]] - total[pieces.first[:-1]]
        again = np.flatnonzero(whole)
        if len(again):
            texts = [t.data[t.offsets[i] : t.offsets[i + 1]].tobytes().decode("utf-8") for i in again.tolist()]
            tokens[again] = self.count(texts)
        return tokens

    def _with_added(self, t: tx.Text) -> np.ndarray:
        marks = np.zeros(t.docs, bool)
        data = t.data.tobytes()
        for added in self.added:
            at = data.find(added)
            while at >= 0:
                marks[np.searchsorted(t.offsets, at, "right") - 1] = True
                at = data.find(added, at + 1)
        return marks


_counters: dict[str, Counter] = {}


def frequent_lengths(docs: DataFrame, tokenizer: Tokenizer, text_col: str) -> Lengths:
    """The table of the pre-tokens that the corpus has most often."""
    table = Lengths(SLOTS)
    if not tokenizer.by_words:
        return table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        names: dict[int, str] = {}
        for batch in batches:
            for _, _, t in tx.texts(batch.column(0)):
                pieces = WordPieces(t)
                distinct, where, n = np.unique(pieces.hashes(), return_index=True, return_counts=True)
                for h, i, c in zip(distinct.tolist(), where.tolist(), n.tolist()):
                    if h in counts:
                        counts[h] += c
                    else:
                        counts[h] = c
                        names[h] = pieces.piece(i)
                if len(counts) > HELD:
                    counts = {h: counts[h] for h in heapq.nlargest(HELD // 2, counts, key=counts.__getitem__)}
                    names = {h: names[h] for h in counts}
        top = heapq.nlargest(SENT, counts, key=counts.__getitem__)
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[h] for h in top], pa.string()), pa.array([counts[h] for h in top], pa.int64())], ["piece", "n"]
        )

    texts = docs.select(F.col(text_col).alias("_text")).where("_text IS NOT NULL")
    top = (
        texts.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece").limit(SLOTS // 2).collect()
    )
    pieces = [r.piece for r in top][::-1]  # the most frequent is put last and stays
    if pieces:
        flat = np.concatenate([np.frombuffer(p.encode("utf-32-le"), np.uint32) for p in pieces])
        end = np.cumsum([len(p) for p in pieces])
        hashes = tx.span_hashes(tx.mix_with(flat.astype(np.uint64), 31), np.concatenate([[0], end[:-1]]), end)
        counts = np.array(tokenizer.counter()(pieces), np.int32)
        for at in range(0, len(pieces), 1024):
            table.put(hashes[at : at + 1024], counts[at : at + 1024])
    return table


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text."""
    tokenizer = Tokenizer.read(path)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((tokenizer, frequent_lengths(docs, tokenizer, text_col)))
    key = f"{path} {shared.id if hasattr(shared, 'id') else id(shared)} {context.applicationId}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(*shared.value)
        counter = _counters[key]
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(1)):
                columns = [pa.array(np.diff(t.offsets), pa.int64()), pa.array(counter.of(t), pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, stop - row), *columns], [id_col, "n_bytes", "n_tokens"])

    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(id_col, F.col(text_col).alias("_text"))
    return read.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long")
