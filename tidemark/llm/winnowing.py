"""Document fingerprints by winnowing, in built-in functions alone.

Every run of ``gram`` code points of a text has a hash: the CRC-32 of its UTF-32 bytes, a polynomial
over their bits.  Of every ``window`` hashes in a row the smallest is chosen, the rightmost of equal
ones, and kept with its position.  Any passage of ``gram + window - 1`` code points that
two texts share thus leaves a common hash in both fingerprints.  A hash and its position are one
number, hash first and position counted down, so the smallest number is the choice; the least
of a window follows from the least of its quarters.  A long text is taken in blocks, which overlap
by what a window needs.

The fingerprint of a text that joins parts of two others follows from theirs; only the windows
over the cut are computed anew.

To compare neighbours in the order of ids, ids are cut into many narrow ranges, and the row that
starts a range is a guest in the range before.  One shuffle brings the texts there; no global
order is built.

Defined results: null texts are empty; an empty text has no fingerprint; a text shorter than
``gram`` has one hash, of its whole; without hashes on both sides the likeness is 1, on one
side 0.  Null ids come last; rows of equal id are ordered by their texts; the only row is its own
neighbour.  No documents give no rows.  Extra columns stay outside, whatever their names.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, WINDOW = 16, 32
#: Positions count down from here in the lower bits.
_LOW = (1 << 31) - 1
#: Windows of a text that are worked on at once.
BLOCK = 1 << 16
#: Rows in a range of ids, and most ranges; only their borders reach the driver.
RANGE_ROWS = 500
MOST_RANGES = 1 << 16
_FAN = 256


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _least(a: Column, width: int) -> Column:
    """The least of every ``width`` elements in a row; the last ones have fewer."""

    def grown(b: Column, have: int) -> Column:
        if have == width:
            return b
        want = min(4 * have, width)
        shifts = sorted({min(k * have, want - have) for k in (1, 2, 3)})  # parts may overlap
        wider = F.transform(b, lambda x, i: F.least(x, *[F.get(b, i + s) for s in shifts]))
        return _let(wider, lambda c: grown(c, want))

    return grown(a, 1)


def _nothing() -> Column:
    return F.array().cast("array<bigint>")


def choices(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The chosen hashes of a text with their positions, each as one number, in order of position."""

    def placed(t: Column, first: Column, last: Column) -> Column:
        return F.transform(
            F.sequence(first, last),
            lambda i: F.shiftleft(F.crc32(F.substring(t["bytes"], 4 * i + 1, F.lit(4 * gram))), 31) + (_LOW - i),
        )

    def block(t: Column, b: Column) -> Column:
        hashes = placed(t, b * BLOCK, F.least(t["n"], (b + 1) * BLOCK + window - 1) - 1)
        return _let(hashes, lambda h: F.when(F.size(h) < window, F.array(F.array_min(h))).otherwise(
            F.array_distinct(F.slice(_least(h, window), F.lit(1), F.size(h) - (window - 1)))))

    length = F.char_length(text)
    # A text shorter than a run is one run.
    parts = F.struct(F.encode(text, "UTF-32").alias("bytes"), F.greatest(length - (gram - 1), F.lit(1)).alias("n"))

    def whole(t: Column) -> Column:
        last = F.floor((F.greatest(t["n"] - (window - 1), F.lit(1)) - 1) / BLOCK).cast("int")
        # Neighbouring blocks may choose the same place.
        return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), last), lambda b: block(t, b))))

    return F.when(length == 0, _nothing()).otherwise(_let(parts, whole))


def hash_of(choice: Column) -> Column:
    return F.shiftright(choice, 31)


def position_of(choice: Column) -> Column:
    """The code point at which the chosen run starts, from 0 on."""
    return (_LOW - choice.bitwiseAND(_LOW)).cast("int")


def entries(chosen: Column) -> Column:
    """A fingerprint as an array of ``hash`` and ``position``."""
    return F.transform(chosen, lambda c: F.struct(hash_of(c).alias("hash"), position_of(c).alias("position")))


def as_text(chosen: Column) -> Column:
    """A fingerprint as ``hash:position`` words."""
    return F.array_join(F.transform(chosen, lambda c: F.concat(hash_of(c).cast("string"), F.lit(":"), position_of(c).cast("string"))), " ")


def hash_set(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, hash_of))


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard similarity of two sets of hashes."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, 1.0).otherwise(shared / union)


def _moved(chosen: Column, by: Column) -> Column:
    """The same choices, ``by`` positions later."""
    return F.transform(chosen, lambda c: c - by)


def _up_to(chosen: Column, start: Column, window: int) -> Column:
    """What the windows from the first one to that at ``start`` chose: choices never go back, so it is
    all up to the choice of the last window, which is the least number in it."""
    inside = F.filter(chosen, lambda c: (position_of(c) >= start) & (position_of(c) < start + window))
    until = _let(position_of(F.array_min(inside)), lambda last: F.filter(chosen, lambda c: position_of(c) <= last))
    return F.when(start >= 0, until).otherwise(_nothing())


def choices_of_joined(
    text: Column, cut: Column, chosen: Column, next_chosen: Column, gram: int = GRAM, window: int = WINDOW
) -> Column:
    """:func:`choices` of ``text``, whose first ``cut`` code points begin one text and whose others begin
    another; only the windows over the cut are computed anew, the others are those of the two texts.
    """
    whole = gram + window - 1  # code points of a window

    def joined(at: Column) -> Column:
        n, own = at["n"], at["cut"]
        left, right = own - whole, n - own - whole
        # Without a window between the two parts there is nothing to choose, but a short text has one window.
        middle = F.when((F.char_length(at["middle"]) >= whole) | (n < whole), _moved(choices(at["middle"], gram, window), at["start"]))
        return F.array_distinct(
            F.concat(_up_to(chosen, left, window), middle.otherwise(_nothing()), _moved(_up_to(next_chosen, right, window), own))
        )

    n, start = F.char_length(text), F.greatest(cut - whole + 1, F.lit(0))
    between = F.substring(text, start + 1, F.least(n, cut + whole - 1) - start)
    return _let(F.struct(n.alias("n"), cut.alias("cut"), start.alias("start"), between.alias("middle")), joined)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """``id_col``, ``n_chars`` and ``fingerprint``, an array of ``hash`` and ``position``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        id_col, F.char_length(text).cast("long").alias("n_chars"), entries(choices(text, gram, window)).alias("fingerprint")
    )


def _borders(docs: DataFrame, id_col: str) -> list:
    """Ids that end ranges of about :data:`RANGE_ROWS` rows, the largest id last."""
    rows = docs.count()
    n = min(MOST_RANGES, max(1, math.ceil(rows / RANGE_ROWS)))
    shares = [i / n for i in range(1, n)]
    found = docs.agg(
        F.max(id_col).alias("last"),
        *([F.percentile_approx(id_col, shares, max(10_000, 4 * n)).alias("inner")] if shares else []),
    ).first()
    inner = (found["inner"] or []) if shares else []
    return sorted({*inner, *([] if found["last"] is None else [found["last"]])})


def with_next(
    docs: DataFrame, id_col: str, text_col: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, carried: tuple[str, ...] = ()
) -> DataFrame:
    """``_id`` and ``_text`` of every row, and ``next_text``: that of the row behind it in descending
    order of ids, behind the last the first.

    ``prepare`` adds columns where the rows have arrived; for those of ``carried`` a ``next_`` column
    is added too.
    """
    borders = _borders(docs, id_col)
    groups = [borders[i : i + _FAN] for i in range(0, len(borders), _FAN)]
    id_type = docs.schema[id_col].dataType.simpleString()
    last = F.from_json(F.lit(json.dumps([g[-1] for g in groups])), f"array<{id_type}>")
    inner = F.from_json(F.lit(json.dumps(groups)), f"array<array<{id_type}>>")
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    own = F.col("_id")
    group = F.size(F.filter(last, lambda x: x < own))
    placed = rows.withColumn("_group", group)
    members = F.get(inner, F.col("_group"))
    inside = F.coalesce(F.size(F.filter(members, lambda x: x < own)), F.lit(0))
    placed = placed.withColumn("_inside", inside)
    at = (F.col("_group") * _FAN + F.greatest(F.col("_inside"), F.lit(0))).cast("int")
    # The row that starts a range, seen from the largest id, is also a guest of the range before.
    starts = F.get(members, F.col("_inside")).eqNullSafe(own)
    before = F.when(at + 1 >= len(borders), F.lit(0)).otherwise(at + 1)
    places = F.array(F.struct(at.alias("range"), F.lit(0).alias("guest")), F.struct(before.alias("range"), F.lit(1).alias("guest")))
    dealt = placed.select("_id", "_text", F.explode(F.when(starts, places).otherwise(F.slice(places, 1, 1))).alias("_at")).select(
        "_id", "_text", F.col("_at.range").alias("_range"), F.col("_at.guest").alias("_guest")
    )
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(len(borders) / 16))
    arrived = prepare(dealt.repartition(tasks, "_range"))
    order = Window.partitionBy("_range").orderBy("_guest", F.col("_id").desc_nulls_last(), "_text")
    names = {"_text": "next_text", **{c: f"next_{c}" for c in carried}}
    return arrived.withColumns({new: F.lead(c).over(order) for c, new in names.items()}).where("_guest = 0").drop("_guest", "_range")


def compare_edited(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half (the last
    ``floor(n / 2)`` code points) is replaced by the first as many of the next document's text.

    ``id_col``, ``n_chars``, ``edited_text``, ``chosen``, ``edited_chosen`` (see :func:`choices`),
    ``near_edited`` and ``near_next``, the likeness to the edited and to the next text.
    """
    joined = with_next(
        docs, id_col, text_col, lambda df: df.withColumn("chosen", choices(F.col("_text"), gram, window)), ("chosen",)
    )
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = joined.withColumn("edited_text", F.concat(F.substring("_text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    both = edited.withColumn(
        "edited_chosen", choices_of_joined(F.col("edited_text"), n - half, F.col("chosen"), F.col("next_chosen"), gram, window)
    )
    sets = both.withColumns({s: hash_set(F.col(c)) for s, c in (("_own", "chosen"), ("_edited", "edited_chosen"), ("_next", "next_chosen"))})
    return sets.select(
        F.col("_id").alias(id_col), n.cast("long").alias("n_chars"), "edited_text", "chosen", "edited_chosen",
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"), likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )
