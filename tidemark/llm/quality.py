"""Quality rules as a bitmask ledger.

Every rule is evaluated once.  The ledger keeps its measurements and one ``failed`` word
in which bit *i* says that rule *i* failed.  A policy is a version name and a mask of
the rules it enforces, so applying a policy, comparing versions and asking what a rule
costs are bitwise work on the ledger: no text is read again.

Defined results: a null or empty text has no words and all measurements 0; equal rows
are measured one by one; extra columns are kept out of the ledger, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as tx

SYMBOLS = "#*$%&|<>"
REPEAT_WIDTH = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the measurement columns; a document without words fails no ratio."""

    name: str
    fails: Callable[[], Column]


#: The bit of a rule is its place here; new rules go to the end.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", lambda: F.col("n_words") < 10),
    Rule("repeated_windows", lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
    Rule("symbols", lambda: 100 * F.col("n_symbols") > 10 * F.col("n_words")),
    Rule("repeated_lines", lambda: (F.col("n_lines") >= 5) & (100 * F.col("n_dup_lines") > 30 * F.col("n_lines"))),
)

#: Versioned policies: the rules each one enforces.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "short_words", "long_words", "symbols"),
    "v2": tuple(rule.name for rule in RULES),
}


def bit(name: str, rules: Sequence[Rule] = RULES) -> int:
    return 1 << [rule.name for rule in rules].index(name)


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    return sum(bit(name, rules) for name in set(names))


def _repeated(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks values that the same owner has twice or more."""
    keys = tx.mix_with(hashes, owner)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    marks = np.empty(len(keys), bool)
    marks[order] = same[1:] | same[:-1]
    return marks


def _again(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks values that the same owner had earlier."""
    keys = tx.mix_with(hashes, owner)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    marks = np.zeros(len(keys), bool)
    marks[order[1:]] = ranked[1:] == ranked[:-1]
    return marks


def measure_text(t: tx.Text) -> list[np.ndarray]:
    """The five measurements, and the number of lines with a word."""
    lead = (t.raw & 0xC0) != 0x80
    # Windows of one document found twice, and the words they cover.
    starts = t.window_starts(REPEAT_WIDTH)
    windows = tx.window_hashes(t.word_hashes(), REPEAT_WIDTH)[starts]
    found = starts[_repeated(windows, t.doc_of_word()[starts])]
    cover = np.zeros(len(t.start) + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + REPEAT_WIDTH, -1)
    covered = np.cumsum(cover[:-1]) > 0
    # Lines with a word that equal an earlier one.
    start, end, owner = t.lines()
    word_bytes = np.concatenate([[0], np.cumsum(t.is_word)])
    filled = word_bytes[end] > word_bytes[start]
    start, end, owner = start[filled], end[filled], owner[filled]
    again = _again(t.span_hashes(start, end), owner)
    return [
        t.words_per_doc(),
        t.per_doc(t.is_word & lead),
        t.per_doc(_SYMBOL[t.raw]),
        np.bincount(owner[again], minlength=t.docs),
        t.per_doc_of_words(covered),
        np.bincount(owner, minlength=t.docs),
    ]


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, :data:`MEASURES` and ``n_lines`` for every row."""
    names = [*MEASURES, "n_lines"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(1)):
                columns = [pa.array(m, pa.int64()) for m in measure_text(t)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, stop - row), *columns], [id_col, *names])

    read = docs.select(id_col, F.col(text_col).alias("_text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return read.mapInArrow(run, ", ".join([f"`{id_col}` {id_type}", *(f"{n} long" for n in names)]))


def ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Measurements and the ``failed`` bits of every rule, evaluated once per document."""
    failed = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        failed = failed.bitwiseOR(F.when(rule.fails(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs, id_col, text_col).withColumn("failed", failed)


def passes(failed: Column, names: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    return failed.bitwiseAND(F.lit(mask(names, rules)).cast("long")) == 0


def apply_policies(
    rows: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One boolean ``kept_<version>`` for each policy."""
    return rows.withColumns({f"kept_{v}": passes(F.col("failed"), names, rules) for v, names in policies.items()})


def ablations(
    rows: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """For each policy and rule of it: documents, kept with and without the rule, and
    rejected by the rule alone.

    The ledger is summed by its ``failed`` word first, so what is shuffled is one row for
    each combination of failures and task.  An empty ledger gives zeros.
    """
    by_word = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    asked = []
    for version, names in policies.items():
        whole = mask(names, rules)
        for name in dict.fromkeys(names):
            own = bit(name, rules)
            hit = F.col("failed").bitwiseAND(F.lit(whole).cast("long"))
            rest = F.col("failed").bitwiseAND(F.lit(whole & ~own).cast("long"))
            asked.append(
                F.struct(
                    F.lit(version).alias("policy"),
                    F.lit(name).alias("rule"),
                    total(F.lit(True)).alias("documents"),
                    total(hit == 0).alias("kept"),
                    total(rest == 0).alias("kept_without"),
                    total(hit == own).alias("sole_reason"),
                )
            )
    return by_word.agg(F.array(*asked).alias("a")).select(F.inline("a"))
