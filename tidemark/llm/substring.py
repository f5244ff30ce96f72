"""Removal of word passages that occur twice or more in a corpus.

A *window* is ``span`` consecutive words of one document.  Every word covered by a window
whose word sequence also starts anywhere else goes, judged on the input.

1. Texts with equal word sequences collapse to one; a text that has a copy and is at least
   a window long goes whole.
2. Winnowing picks anchors, the least hashed 8-word run of every window: equal windows
   pick equal anchors.  Only windows with an anchor found twice can repeat, and
   they alone are counted, by hash.
3. The first places of the repeated windows are the reference.  It is cut into shards of
   bounded size, and the shard's text, a tenth of its automaton's size, is sent to every
   block of passages to be searched in it.  There a suffix automaton of the shard is built,
   the passages are streamed for their matching statistics (the longest match ending at
   each word), and maximal spans of at least ``span`` words are removed.  The automaton works
   on the words themselves.

A passage that many documents share is one reference passage; the documents that have it
are dealt over as many blocks as their words need.

Defined results: null and empty texts have no words; an unchanged text keeps its white
space (``kept`` is null); equal rows are copies of each other, also with a null id.  Texts
and windows are told apart by 64-bit hashes before the words are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ship
from tidemark.llm import text as tx

SPAN = 35
ANCHOR_WORDS = 8
#: Words of reference in a shard, and of passages streamed through one automaton, on average.
SHARD_WORDS = 40_000
BLOCK_WORDS = 400_000


class Automaton:
    """The suffix automaton of passages of words; a match never crosses two passages."""

    def __init__(self, passages: Iterator[list[bytes]]):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        last = 0
        for number, passage in enumerate(passages):
            for word in passage:
                last = self._extend(last, word)
            last = self._extend(last, number)  # no word is a number

    def _extend(self, last: int, word) -> int:
        follow, link, length = self.next, self.link, self.length
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        if at >= 0:
            to = follow[at][word]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                twin = len(follow)
                follow.append(dict(follow[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and follow[at].get(word) == to:
                    follow[at][word] = twin
                    at = link[at]
                link[to] = link[new] = twin
        return new

    def matches(self, words: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal spans (start, end) of at least ``least`` words that a passage contains."""
        follow, link, length = self.next, self.link, self.length
        state = size = 0
        spans: list[tuple[int, int]] = []
        for i, word in enumerate(words):
            to = follow[state].get(word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = follow[state].get(word)
            if to is None:
                size = 0
                continue
            state = to
            size += 1
            if size >= least:
                start = i + 1 - size
                if spans and start <= spans[-1][1]:
                    spans[-1] = (min(spans[-1][0], start), i + 1)
                else:
                    spans.append((start, i + 1))
        return spans


def anchor_places(t: tx.Text, hashes: np.ndarray, span: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window, and the place of its anchor: the least run, the first of equals."""
    starts = t.window_starts(span)
    reach = span - ANCHOR_WORDS + 1
    if not len(starts):
        return starts, starts

    def least(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(grams[left] <= grams[right], left, right)

    best, width = np.arange(len(grams)), 1
    while 2 * width <= reach:
        best = least(best[:-width], best[width:])
        width *= 2
    if width < reach:
        best = least(best[: len(best) - (reach - width)], best[reach - width :])
    return starts, best[starts]


def _text_keys(t: tx.Text, hashes: np.ndarray) -> np.ndarray:
    return tx.span_hashes(hashes, t.first[:-1], t.first[1:]).view(np.int64)


def _joined(t: tx.Text, i: int) -> list[bytes]:
    return t.data[t.offsets[i] : t.offsets[i + 1]].tobytes().split()


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _base(docs: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    """Per row: ``id``, the ``key`` of its words, ``n_words``, ``sha`` and its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(1)):
                h = t.word_hashes()
                grams = tx.window_hashes(h, ANCHOR_WORDS)
                _, places = anchor_places(t, h, span, grams)
                places = np.unique(places)
                counts = np.diff(np.searchsorted(places, t.first))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, stop - row),
                        pa.array(_text_keys(t, h), pa.int64()),
                        pa.array(t.words_per_doc(), pa.int64()),
                        pa.array([_digest(_joined(t, i)) for i in range(t.docs)], pa.string()),
                        tx.list_array(grams[places].view(np.int64), counts, pa.int64()),
                    ],
                    ["id", "key", "n_words", "sha", "anchors"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return read.mapInArrow(run, f"id {id_type}, key long, n_words long, sha string, anchors array<long>")


def _keyed_texts(docs: DataFrame, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(0)):
                keys = pa.array(_text_keys(t, t.word_hashes()), pa.int64())
                yield pa.RecordBatch.from_arrays([keys, batch.column(0).slice(row, stop - row)], ["key", "text"])

    return docs.select(F.col(text_col).alias("_text")).mapInArrow(run, "key long, text string")


def _windows(texts: DataFrame, span: int) -> DataFrame:
    """``hash``, ``key``, ``at`` of every window with one of the text's repeated ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0), np.int64)
            anchors = batch.column(2)
            counts = np.asarray(anchors.value_lengths().fill_null(0), np.int64)
            flat = np.asarray(anchors.flatten(), np.int64).view(np.uint64)
            border = np.concatenate([[0], np.cumsum(counts)])
            for row, stop, t in tx.texts(batch.column(1)):
                h = t.word_hashes()
                grams = tx.window_hashes(h, ANCHOR_WORDS)
                starts, places = anchor_places(t, h, span, grams)
                own = t.doc_of_word()[starts] if len(starts) else starts
                known = tx.mix_with(flat[border[row] : border[stop]], np.repeat(np.arange(stop - row), counts[row:stop]))
                use = np.isin(tx.mix_with(grams[places], own), known) if len(starts) else np.zeros(0, bool)
                starts, own = starts[use], own[use]
                windows = tx.window_hashes(h, span)[starts] if len(starts) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(windows.view(np.int64), pa.int64()),
                        pa.array(keys[row + own], pa.int64()),
                        pa.array(starts - t.first[own], pa.int32()),
                    ],
                    ["hash", "key", "at"],
                )

    return texts.select("key", "text", "anchors").mapInArrow(run, "hash long, key long, at int")


def _passages(rows: DataFrame, span: int) -> DataFrame:
    """The runs of windows of each row as passages: their first word and their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, kind, keys = (batch.column(i) for i in range(3))
            counts = np.asarray(batch.column(4).value_lengths(), np.int64)
            at = np.asarray(batch.column(4).flatten(), np.int64)
            border = np.concatenate([[0], np.cumsum(counts)])
            for row, stop, t in tx.texts(batch.column(3)):
                starts = at[border[row] : border[stop]]
                own = np.repeat(np.arange(stop - row), counts[row:stop])
                first = np.ones(len(starts), bool)
                first[1:] = (np.diff(starts) != 1) | (own[1:] != own[:-1])
                head = np.flatnonzero(first)
                tail = np.append(head[1:], len(starts)) - 1
                n = starts[tail] - starts[head] + span
                left = t.start[t.first[own[head]] + starts[head]]
                right = t.end[t.first[own[head]] + starts[tail] + span - 1]
                texts = [t.data[a:b].tobytes().decode("utf-8") for a, b in zip(left.tolist(), right.tolist(), strict=True)]
                pick = pa.array(row + own[head], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        shard.take(pick), kind.take(pick), keys.take(pick),
                        pa.array(starts[head], pa.int32()), pa.array(n, pa.int64()), pa.array(texts, pa.string()),
                    ],
                    ["shard", "kind", "key", "at", "n", "passage"],
                )

    return rows.select("shard", "kind", "key", "text", "starts").mapInArrow(
        run, "shard long, kind int, key long, at int, n long, passage string"
    )


def _search(block: pd.DataFrame, span: int) -> pd.DataFrame:
    """Maximal spans of a block's passages that the shard's reference contains."""
    reference = block.loc[block["kind"] == 0, "passage"]
    automaton = Automaton(p.encode().split() for p in reference)
    found = []
    asked = block[block["kind"] == 1]
    for key, at, passage in zip(asked["key"], asked["at"], asked["passage"], strict=True):
        found.extend((key, at + a, at + b) for a, b in automaton.matches(passage.encode().split(), span))
    return pd.DataFrame(found, columns=["key", "start", "stop"]).astype({"key": "int64", "start": "int32", "stop": "int32"})


def _cut(texts: DataFrame) -> DataFrame:
    """``key``, ``removed`` (words), ``kept`` and its ``kept_sha`` for texts with ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = text.encode().split()
                keep = np.ones(len(words), bool)
                for s in spans:
                    keep[s["start"] : s["stop"]] = False
                rest = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                for column, value in zip(out, (key, len(words) - len(rest), b" ".join(rest).decode(), _digest(rest)), strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["key", "removed", "kept", "kept_sha"]
            )

    return texts.select("key", "text", "spans").mapInArrow(run, "key long, removed long, kept string, kept_sha string")


def repeated_spans(
    one: DataFrame, docs: DataFrame, text_col: str, span: int, scratch: ship.Scratch
) -> tuple[DataFrame, DataFrame]:
    """The candidate texts by key, and the spans (key, start, stop) to remove from them."""
    anchors = one.select("key", F.explode("anchors").alias("anchor"))
    twice = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    candidates = scratch.keep(
        anchors.join(ship.measured(twice), "anchor").groupBy("key").agg(F.collect_list("anchor").alias("anchors"))
    )
    texts = scratch.keep(
        _keyed_texts(docs, text_col).join(ship.measured(candidates.select("key")), "key", "left_semi").dropDuplicates(["key"])
    )
    windows = scratch.keep(_windows(texts.join(candidates, "key"), span))
    first = scratch.keep(
        windows.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at")).alias("place"))
        .where("n > 1")
        .select("hash", F.col("place.key").alias("ref"), F.col("place.at").alias("at"))
    )
    shards = 1 + first.count() // SHARD_WORDS
    shard = F.pmod(F.xxhash64("ref"), F.lit(shards)).cast("long")
    sorted_places = F.array_sort(F.collect_list("at")).alias("starts")
    reference = first.groupBy(F.col("ref").alias("key"), shard.alias("shard")).agg(sorted_places).withColumn("kind", F.lit(0))
    asked = (
        windows.join(first.select("hash", shard.alias("shard")), "hash")
        .groupBy("key", "shard").agg(sorted_places).withColumn("kind", F.lit(1))
    )
    passages = scratch.keep(_passages(reference.unionByName(asked).join(texts, "key"), span))
    blocks = passages.where("kind = 1").groupBy("shard").agg(
        F.ceil(F.sum("n") / F.lit(BLOCK_WORDS)).cast("long").alias("blocks")
    )
    dealt = passages.join(F.broadcast(blocks) if shards <= ship.BROADCAST_ROWS else blocks, "shard").withColumn(
        "block",
        F.explode(
            F.when(F.col("kind") == 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(
                F.array(F.pmod(F.xxhash64("key", "at"), "blocks"))
            )
        ),
    )
    spans = dealt.select("shard", "block", "kind", "key", "at", "passage").groupBy("shard", "block").applyInPandas(
        lambda block: _search(block, span), "key long, start int, stop int"
    )
    return texts, spans


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """Per row: ``id_col``, ``n_words``, ``n_removed``, ``kept_sha256`` of the kept words joined
    by one blank, and ``kept``, these words, or null where nothing is removed."""
    if span < ANCHOR_WORDS:
        raise ValueError(f"span must be at least {ANCHOR_WORDS} words")
    scratch = ship.Scratch(docs.sparkSession)
    base = scratch.keep(_base(docs, id_col, text_col, span))
    one = scratch.keep(
        base.where(F.col("n_words") >= span).groupBy("key").agg(F.first("anchors").alias("anchors"), F.count(F.lit(1)).alias("copies"))
    )
    texts, spans = repeated_spans(one, docs, text_col, span, scratch)
    by_text = spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = scratch.keep(_cut(texts.join(by_text, "key")))
    copied = one.where("copies > 1").select("key", F.lit(True).alias("_copied"))
    whole = F.col("_copied").isNotNull()
    return scratch.result(
        base.drop("anchors")
        .join(copied, "key", "left")
        .join(cut, "key", "left")
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
            F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        )
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts; other columns stay as they are.

    Rows are matched by their id and their text, so ids can be null or those of several texts.
    """
    row, changed, kept = (ship.free_name(docs, c) for c in ("_row", "_changed", "_kept"))
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"))
    numbered = docs.select(key.alias(row), F.col(text_col).alias("_text"))
    cut = removals(numbered, row, "_text", span).where("kept IS NOT NULL").select(
        F.col(row).alias(changed), F.col("kept").alias(kept)
    ).dropDuplicates([changed])
    return docs.join(cut, key == F.col(changed), "left").select(
        *[F.coalesce(kept, text_col).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    )
