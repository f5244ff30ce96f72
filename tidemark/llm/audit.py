"""Which filter removes what, for every order of the filters.

A text is read once by a table-driven byte transducer.  Its states are the classes of the
byte before (gap, word, ...), its input the class of the next byte; one table gives the
actions of every step: a word begins, a word ends, a code point, a capital, a symbol.  UTF-8
needs no other state, as a byte alone tells whether it begins a code point.  The words it
cuts go as spans into an open-addressing hash table, in which spans of equal hash
are verified byte by byte, so the number of distinct words is exact.

Every filter is thus evaluated once for each document and kept as a bit.  The reports of
all orders follow from the number of documents of each part, bit word and label, which is a
small table whatever the number of documents.  Equal texts are found by their SHA-256: the
smallest id of each comes from one aggregate that combines before its shuffle, and
is joined back by (text, id), so a text with many copies never meets in one task.

Defined results: null texts are empty, words are case-sensitive; a null source is the part
``''``; a null id comes behind every id, so it repeats any text that a row with an id has; rows of
equal id and text do not repeat each other; a label counts if any row of its id has it, a null id has
none; no documents give no rows.  A text of any length is read whole.  Extra columns stay
outside, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ship
from tidemark.llm import text as tx

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"

# Byte classes; the class of the byte before is the state.
GAP, LETTER, CAPITAL, SYMBOL, INNER, END = range(6)
_CLASSES = 8
# Actions of a step, as bits.
BEGINS, ENDS, POINT, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8, 16
#: Stands behind each document; no UTF-8 text has this byte.
_END_BYTE = 0xFF
#: Spans up to this many bytes are verified eight bytes at a time.
_CHUNKED = 64


def _byte_classes() -> np.ndarray:
    classes = np.full(256, LETTER, np.uint8)
    classes[[9, 10, 11, 12, 13, 32]] = GAP
    classes[65:91] = CAPITAL
    classes[list(SYMBOLS)] = SYMBOL
    classes[0x80:0xC0] = INNER
    classes[_END_BYTE] = END
    return classes


def _actions() -> np.ndarray:
    """What happens on each (state, class of the next byte)."""
    table = np.zeros((_CLASSES, _CLASSES), np.uint8)
    for state, seen in itertools.product(range(END + 1), repeat=2):
        was, now = state not in (GAP, END), seen not in (GAP, END)
        table[state, seen] = (
            (BEGINS if now and not was else 0)
            | (ENDS if was and not now else 0)
            | (POINT if seen not in (INNER, END) else 0)
            | (IS_CAPITAL if seen == CAPITAL else 0)
            | (IS_SYMBOL if seen == SYMBOL else 0)
        )
    return table.ravel()


BYTE_CLASSES, ACTIONS = _byte_classes(), _actions()


class Scan:
    """One pass over a few documents: the spans of their words and what was counted."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.docs = len(offsets) - 1
        own = np.arange(len(data)) + np.repeat(np.arange(self.docs), np.diff(offsets))
        stop = offsets[1:] + np.arange(self.docs)
        # Eight bytes more, so that every span can be read in whole words.
        self.data = np.full(len(data) + self.docs + 8, _END_BYTE, np.uint8)
        self.data[own] = data
        size = len(data) + self.docs
        seen = BYTE_CLASSES[self.data[:size]]
        step = np.empty(size, np.uint8)
        step[1:] = seen[:-1] * _CLASSES
        step[:1] = END * _CLASSES
        step += seen
        done = ACTIONS[step]
        begin = stop - np.diff(offsets)
        self.start = np.flatnonzero(done & BEGINS)
        self.end = np.flatnonzero(done & ENDS)
        self.doc = np.searchsorted(stop, self.start)
        self.words = np.bincount(self.doc, minlength=self.docs)
        self.points, self.capitals, self.symbols = (
            np.add.reduceat((done & action) != 0, begin, dtype=np.int64) if self.docs else np.zeros(0, np.int64)
            for action in (POINT, IS_CAPITAL, IS_SYMBOL)
        )

    def distinct_words(self) -> np.ndarray:
        """Distinct words of each document."""
        return np.bincount(self.doc[self._inserted()], minlength=self.docs)

    def _inserted(self) -> np.ndarray:
        """The spans that the hash table took in as new."""
        n = len(self.start)
        hashes = tx.mix_with(tx.span_hashes(tx._BYTE_VALUES[self.data], self.start, self.end), self.doc)
        mask = (1 << max(4, int(2 * n).bit_length())) - 1
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        table = np.full(mask + 1, -1, np.int64)
        new = np.zeros(n, bool)
        waiting = np.arange(n)
        while len(waiting):
            at = slot[waiting]
            free = table[at] < 0
            # The first span of those that meet at a free slot gets it.
            table[at[free][::-1]] = waiting[free][::-1]
            holder = table[at]
            done = holder == waiting
            new[waiting[done]] = True
            like = np.flatnonzero(~done & (hashes[holder] == hashes[waiting]) & (self.doc[holder] == self.doc[waiting]))
            done[like] = self._equal(holder[like], waiting[like])
            waiting = waiting[~done]
            slot[waiting] = (slot[waiting] + 1) & mask
        return np.flatnonzero(new)

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the spans hold the same bytes."""
        left, right = self.start[a], self.start[b]
        length = self.end[a] - left
        same = length == self.end[b] - right
        words = np.lib.stride_tricks.as_strided(self.data[:8].view("<u8"), (len(self.data) - 7,), (1,))
        done = 0
        open_ = np.flatnonzero(same & (length <= _CHUNKED))
        while len(open_):
            rest = np.minimum(length[open_] - done, 8).astype(np.uint64)
            keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest)
            differ = (words[left[open_] + done] ^ words[right[open_] + done]) & keep
            same[open_[differ != 0]] = False
            done += 8
            open_ = open_[(differ == 0) & (length[open_] > done)]
        for i in np.flatnonzero(same & (length > _CHUNKED)).tolist():
            same[i] = np.array_equal(self.data[left[i] : left[i] + length[i]], self.data[right[i] : right[i] + length[i]])
        return same


MEASURES = ("n_words", "n_distinct", "n_points", "n_capitals", "n_symbols")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``id``, ``part``, the measures of the transducer and the ``digest`` of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(0)):
                scan = Scan(t.raw, t.offsets)
                raw = memoryview(np.ascontiguousarray(t.raw))
                borders = t.offsets.tolist()
                digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(borders, borders[1:])]
                counted = (scan.words, scan.distinct_words(), scan.points, scan.capitals, scan.symbols)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(row, stop - row), batch.column(2).slice(row, stop - row),
                        *[pa.array(c, pa.int64()) for c in counted], pa.array(digests, pa.binary()),
                    ],
                    ["id", "part", *MEASURES, "digest"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(
        F.col(text_col).alias("_text"), F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("_part")
    )
    return read.mapInArrow(run, f"id {id_type}, part string, " + "".join(f"{m} long, " for m in MEASURES) + "digest binary")


def failures(measured: DataFrame) -> DataFrame:
    """``id``, ``part`` and ``failed``, a bit for each filter that the document fails."""
    least = measured.groupBy(F.col("digest").alias("_digest")).agg(F.min("id").alias("_least"))
    first = (F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("_least"))
    fails = {
        "A": F.col("n_words") < 50,
        "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > 5 * F.col("n_points"),
        "D": F.col("n_symbols") > 0,
        "E": F.col("_digest").isNull(),
    }
    bits = sum((F.when(fails[f], F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(FILTERS)), F.lit(0))
    return measured.join(least, first, "left").select("id", "part", bits.cast("int").alias("failed"))


def with_labels(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``good`` and ``toxic``, 1 where any label of the id says so."""
    known = (
        labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
        .agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(f"_{c}") for c in ("quality", "toxic")])
    )
    return failed.join(known, F.col("id") == F.col("_id"), "left").select(
        "id", "part", "failed", F.coalesce("_quality", F.lit(0)).alias("good"), F.coalesce("_toxic", F.lit(0)).alias("toxic")
    )


def interactions(labelled: DataFrame) -> DataFrame:
    """One row for each part, order of the filters, and step; counts of documents."""
    cells = labelled.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic")
    )
    # At most one entry for each bit word.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = [
        {"filter_order": "".join(o), "step": i + 1, "before": sum(bit[f] for f in o[:i]), "own": bit[o[i]]}
        for o in itertools.permutations(FILTERS) for i in range(len(FILTERS))
    ]
    known = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,before:int,own:int>>")
    rows = parts.select("part", "cells", F.inline(known))
    before, own, orders = F.col("before"), F.col("own"), len(steps) // len(FILTERS)

    def total(of: str, condition) -> Column:
        chosen = F.transform(F.filter("cells", condition), lambda c: c[of])
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, x: a + x)

    def removed(c):
        return (c["failed"].bitwiseAND(own) != 0) & (c["failed"].bitwiseAND(before) == 0)

    # A document is removed by each of the filters it fails in an equal share of the orders.
    shares = F.transform(
        F.filter("cells", lambda c: c["failed"].bitwiseAND(own) != 0),
        lambda c: c["n"] * F.floor(F.lit(orders) / F.bit_count(c["failed"])),
    )
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda c: c["failed"].bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda c: (c["failed"].bitwiseAND(own) != 0) & (c["failed"].bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda c: c["failed"] == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        F.aggregate(shares, F.lit(0).cast("long"), lambda a, x: a + x).alias("shapley"),
    )


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """What each filter removes at each place of every order, for each part of ``docs``."""
    scratch = ship.Scratch(docs.sparkSession)
    measured = scratch.keep(measures(docs, id_col, text_col, part_col))
    return scratch.result(interactions(with_labels(failures(measured), labels, id_col)))
