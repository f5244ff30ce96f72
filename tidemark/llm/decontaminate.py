"""Benchmark decontamination: short test items found inside long documents.

Containment search after MinHash, with built-in functions only.  An item of *n* distinct
shingles is contained when at least ``threshold * n`` of them are in the document, so at
most *m = n - ceil(threshold * n)* may be missing.  Of **any** *m + 1* of its shingles one
must then be in the document.  Items are partitioned by size, and the sketch of an item is
its *m + 1* smallest shingle hashes: a bottom-k MinHash whose *k* belongs to the size
partition, so that the search misses nothing.  Documents are of any length, so they are
probed with all their shingle hashes and never sketched.  Candidates are verified on the
shingles themselves.

Defined results: texts are compared as A-Z lower-cased words; null and empty texts contain
nothing and are contained in nothing; an item with fewer words than ``width`` has its whole
sequence as its only shingle; repeated rows of an id are read as one document; rows with a
null id are never reported.  Extra columns stay outside, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ship

WIDTH = 5
#: Containment as a fraction, in integers, so that the border is exact.
THRESHOLD = (4, 5)
#: Most sketch rows that are broadcast (24 bytes each); more are joined by a shuffle.
SKETCH_ROWS = 2_000_000
#: Most item shingles (one row of text each) that are broadcast.
SHINGLE_ROWS = 200_000


def words(text: Column) -> Column:
    """Lower-cased words; null and empty texts have none."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, "[\\x20\\x09-\\x0D]+"), "")


def _starts(w: Column, width: int) -> Column:
    return F.when(F.size(w) >= width, F.sequence(F.lit(0), F.size(w) - width)).otherwise(
        F.array().cast("array<int>")
    )


def shingle_hashes(w: Column, width: int) -> Column:
    return F.transform(_starts(w, width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))


def shingles(w: Column, width: int) -> Column:
    """Distinct runs of ``width`` words; words hold no blanks, so the joined text is exact."""
    return F.array_distinct(F.transform(_starts(w, width), lambda i: F.array_join(F.slice(w, i + 1, width), " ")))


def item_sketches(
    items: DataFrame, id_col: str, text_col: str, width: int, threshold: tuple[int, int]
) -> tuple[DataFrame, DataFrame]:
    """The items' shingles, and the sketch as rows of (width, hash, item)."""
    num, den = threshold
    w = items.select(F.col(id_col).alias("_item"), words(F.col(text_col)).alias("_w")).where(
        F.col("_item").isNotNull() & (F.size("_w") > 0)
    )
    # One row for each width in use: the full one, and those of shorter items.
    by_width = [
        w.where(F.size("_w") >= width if k == width else F.size("_w") == k).select(
            "_item", F.lit(k).alias("_width"), shingles(F.col("_w"), k).alias("_shingles")
        )
        for k in range(1, width + 1)
    ]
    sets = by_width[0]
    for part in by_width[1:]:
        sets = sets.unionByName(part)
    sets = sets.distinct()
    n = F.size("_shingles")
    missing_allowed = n - F.ceil(n * num / F.lit(den)).cast("int")
    # Places beyond the words of a short item are null, and a null adds nothing to a hash.
    parts = F.transform("_shingles", lambda s: F.split(s, " "))
    hashes = F.array_sort(
        F.array_distinct(F.transform(parts, lambda s: F.xxhash64(*[F.get(s, F.lit(k)) for k in range(width)])))
    )
    partitioned = sets.withColumns({"_partition": missing_allowed, "_hashes": hashes})
    sketches = partitioned.select(
        "_item", "_width", F.explode(F.slice("_hashes", F.lit(1), F.col("_partition") + 1)).alias("_hash")
    )
    return sets, sketches


def contained(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """One row per contained pair: document, item, the item's shingles and those shared."""
    num, den = threshold
    sets, sketches = item_sketches(items, item_id_col, item_text_col, width, threshold)
    sketches = ship.measured(sketches, SKETCH_ROWS)
    sets = ship.measured(sets, 0)
    used = sorted({r._width for r in sets.select("_width").distinct().collect()} | {width})

    read = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_doc"), words(F.col(text_col)).alias("_w")
    )
    hits = None
    for k in used:
        probe = read.select("_doc", F.explode(shingle_hashes(F.col("_w"), k)).alias("_hash"))
        own = sketches.where(F.col("_width") == k).select("_hash", "_item")
        found = probe.join(own, "_hash").select("_doc", "_item").distinct()
        hits = found if hits is None else hits.unionByName(found)
    candidates = ship.measured(hits)

    # Only documents with a candidate are read again, and only they are shingled as text.
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    again = texts.join(ship.measured(candidates.select("_doc").distinct()), "_doc", "left_semi").select(
        "_doc", words(F.col("_text")).alias("_w")
    )
    flat = ship.measured(
        sets.select("_item", "_width", F.size("_shingles").cast("long").alias("_n"), F.explode("_shingles").alias("_s")),
        SHINGLE_ROWS,
    )
    met = None
    for k in used:
        own = flat.where(F.col("_width") == k).select("_item", "_n", "_s")
        part = again.select("_doc", F.explode(shingles(F.col("_w"), k)).alias("_s")).join(own, "_s")
        met = part if met is None else met.unionByName(part)
    counted = (
        met.join(candidates, ["_doc", "_item"])
        .groupBy("_doc", "_item", "_n")
        .agg(F.countDistinct("_s").alias("_shared"))
        .where(F.col("_shared") * den >= F.col("_n") * num)
    )
    return _result(counted, id_col, item_id_col)


def _result(rows: DataFrame, id_col: str, item_id_col: str) -> DataFrame:
    return rows.select(
        F.col("_doc").alias(id_col),
        F.col("_item").alias(item_id_col),
        F.col("_n").alias("n_item_shingles"),
        F.col("_shared").alias("n_shared"),
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` without the documents that contain an item; rows with a null id stay."""
    leaked = ship.free_name(docs, "_leaked")
    found = contained(docs, items, id_col, text_col, **options).select(F.col(id_col).alias(leaked)).distinct()
    return docs.join(ship.measured(found), F.col(id_col) == F.col(leaked), "left_anti")
