"""Near-duplicate documents by the Jaccard similarity of word n-grams, exactly.

1. A document becomes the set of its n-gram hashes.  Equal sets collapse to one node, and one document
   stands for it from then on.
2. Sets of similar size share a *size band*.  In a band, linked sets differ in at most *k*
   n-grams, so of ``k + m + 1`` hash parts of the n-gram space at least ``m + 1`` hold the same
   n-grams in both.  Sets that share such parts meet under one key; no linked pair is missed,
   and unlike sets hardly ever meet.  Parts that are empty in both count only for sets with so few others
   that all could differ.  As linked sets share several keys, each node leaves its most frequent ones out.
3. Key groups are searched without listing their pairs: in a few rounds each member meets one pivot of
   each of its groups, which then leaves them (copies join here, small groups are done).  Groups that still hold several components are merged where they share
   one, so that a node is searched once whatever its number of keys, in bounded tiles of
   like sizes, block against block.  The bit counts of hashed bitmaps bound an overlap from
   above, and only pairs that can still reach the threshold get the exact intersection of their
   sorted arrays, which lie in files of the shared folder and are read by range.  A tile returns a spanning forest: at most as many links as it has rows.
4. Links are contracted to components.

Defined results: words are A-Z lower-cased; a document with fewer words than ``width`` is its
whole sequence as one n-gram; one without words (null, empty) is empty and linked with
nothing; repeated rows of an id link to themselves; a null id is a document of its own
class.  Extra columns stay outside.  N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import ship, store
from tidemark.llm import text as tx
from tidemark.llm.components import components

#: N-grams for each 64-bit word of a bitmap: sixteen bits or more for an n-gram, so that few collide.
GRAMS_PER_WORD = 4
#: Most rows and n-grams of a block; a tile has one or two blocks.
TILE_ROWS = 2_048
TILE_GRAMS = 1 << 21
#: Bytes of a file of n-grams, and n-grams that a task keeps of them.
GRAM_FILE_BYTES = 32 << 20
#: Rounds in which every member meets the pivot of each of its groups, before groups become tiles.
PIVOT_ROUNDS = 3
CACHED_GRAMS = 1 << 23
#: Most shared keys (sixteen bytes each, with their counts) that are broadcast to find their members.
KEY_ROWS = 2_000_000
_KEY_BITS = (1 << 48) - 1
#: The first bits of a key are its band.
_BAND_SHIFT = 57
_BAND_RATIO = 1.5
#: Up to so many differing n-grams, keys are made of two parts instead of one.
_PAIRED_UP_TO = 14
#: One part more for so many differing n-grams, all of which linked sets share.
_SPARE_EACH = 12


class Bands:
    """Size bands and the number of parts in each, for a threshold ``num / den``."""

    def __init__(self, num: int, den: int, largest: int = 1 << 40):
        self.num, self.den = num, den
        upper = [max(1, (den + num) // (2 * (den - num)) - 1)] if num < den else [1]
        while upper[-1] < largest:
            upper.append(int(upper[-1] * _BAND_RATIO) + 1)
        self.upper = np.array(upper, np.int64)
        self.differing = 2 * self.upper * (den - num) // (den + num)
        self.joined = np.where(self.differing <= _PAIRED_UP_TO, 2, 1)
        self.parts = self.differing + self.joined + 1 + np.where(self.joined == 1, self.differing // _SPARE_EACH, 0)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.upper, size)

    def last(self, size: np.ndarray) -> np.ndarray:
        """The band of the largest set that can still link with one of this size."""
        return self.of(size * self.den // max(1, self.num))


def document_sets(t: tx.Text, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes, sorted within each document, and their number per document."""
    h = t.word_hashes()
    n = t.words_per_doc()
    starts = t.window_starts(width)
    grams = tx.window_hashes(h, width)[starts] if len(starts) else np.zeros(0, np.uint64)
    owner = t.doc_of_word()[starts]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        grams = np.concatenate([grams, tx.span_hashes(h, t.first[short], t.first[short + 1])])
        owner = np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    first = np.ones(len(grams), bool)
    first[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[first], np.bincount(owner[first], minlength=t.docs)


def _node(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One hash for each set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tx.mix_with(grams, 7))])
    border = np.concatenate([[0], np.cumsum(sizes)])
    return tx.mix_with(total[border[1:]] - total[border[:-1]], sizes)


def _banded(keys: np.ndarray, band: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - _BAND_SHIFT) | band.astype(np.uint64) << np.uint64(_BAND_SHIFT)


def part_keys(grams: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all documents, how many each has, and for each band from the document's own on how many more
    than one it shares at least with every set it links with."""
    low, high = bands.of(sizes), bands.last(sizes)
    more = np.zeros((len(sizes), int((high - low).max(initial=0)) + 1), np.int64)
    keys, owners = [], []
    border = np.concatenate([[0], np.cumsum(sizes)])
    for step in range(int((high - low).max(initial=0)) + 1):
        docs = np.flatnonzero((sizes > 0) & (low + step <= high) & (bands.differing[np.minimum(low + step, len(bands.upper) - 1)] > 0))
        if not len(docs):
            continue
        band = low[docs] + step
        parts, joined = bands.parts[band], bands.joined[band]
        own = np.repeat(np.arange(len(docs)), sizes[docs])
        g = grams[np.repeat(border[docs] - (np.cumsum(sizes[docs]) - sizes[docs]), sizes[docs]) + np.arange(len(own))]
        place = np.cumsum(parts) - parts
        part = (tx.mix_with(g, 11) % parts[own].astype(np.uint64)).astype(np.int64)
        at = place[own] + part
        held = np.bincount(at, minlength=int(parts.sum()))
        content = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(content, at, tx.mix_with(g, 13))
        doc_of = np.repeat(np.arange(len(docs)), parts)
        index = np.arange(len(doc_of)) - place[doc_of]
        empty = held == 0
        # Links of a set of this size in this band differ in so many n-grams at most, each of which spoils one
        # part.  A set with more parts that hold n-grams than that shares one of them with all it links with;
        # others, hardly any, need shared parts that are empty as well.
        n, upper = sizes[docs], bands.upper[np.minimum(band, len(bands.upper) - 1)]
        differing = (n + np.minimum(upper, n * bands.den // max(1, bands.num))) * (bands.den - bands.num) // (bands.den + bands.num)
        full = parts - np.bincount(doc_of[empty], minlength=len(docs))
        single = (joined[doc_of] == 1) & (~empty | (full <= differing)[doc_of])
        spared = np.maximum(0, full - differing)
        more[docs, step] = np.maximum(1, np.where(joined == 1, spared, spared * (spared - 1) // 2)) - 1
        content = tx.mix_with(content, index + 1000 * band[doc_of])
        keys.append(_banded(tx.mix_with(content[single], 17), band[doc_of[single]]))
        owners.append(docs[doc_of[single]])
        for p in np.unique(parts[joined == 2]).tolist():
            members = np.flatnonzero((parts == p) & (joined == 2))
            rows = place[members][:, None] + np.arange(p)[None, :]
            i, j = np.triu_indices(p, 1)
            both = tx.mix_with(content[rows[:, i]], 19) + content[rows[:, j]]
            # Two shared parts with n-grams, one, or none, by what the spoiled ones leave.
            use = np.minimum(2, spared[members])[:, None] <= 2 - empty[rows[:, i]].astype(np.int64) - empty[rows[:, j]]
            keys.append(_banded(tx.mix(both)[use], np.repeat(band[members], use.sum(axis=1))))
            owners.append(np.repeat(docs[members], use.sum(axis=1)))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(len(sizes), np.int64), more
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return keys[order], np.bincount(owners, minlength=len(sizes)), more


def bitmap_words(sizes: np.ndarray) -> np.ndarray:
    """Words of a bitmap, a power of two that grows with the set."""
    needed = np.maximum(1, -(-sizes // GRAMS_PER_WORD))
    return 1 << np.ceil(np.log2(needed)).astype(np.int64)


def bitmaps(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hashed bitmap for each document, one after the other, and their words."""
    words = bitmap_words(sizes)
    start = np.cumsum(words) - words
    owner = np.repeat(np.arange(len(sizes)), sizes).astype(np.int64)
    bit = tx.mix_with(grams, 23) & (words[owner] * 64 - 1).astype(np.uint64)
    out = np.zeros(int(words.sum()), np.uint64)
    np.bitwise_or.at(out, start[owner] + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out, words


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap at a smaller width: its parts laid over each other."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def reaches(shared, a, b, num: int, den: int):
    """Whether ``shared`` of sets of sizes ``a`` and ``b`` is a similarity of num / den."""
    return shared * (num + den) >= num * (a + b)


def _can_reach(bits_a: np.ndarray, bits_b: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """False only where the bitmaps prove that the threshold is out of reach.

    Each bit that one side has alone stands for an n-gram which the other side lacks.
    """
    alone_a = np.bitwise_count(bits_a & ~bits_b).sum(axis=-1, dtype=np.int64)
    alone_b = np.bitwise_count(bits_b & ~bits_a).sum(axis=-1, dtype=np.int64)
    return reaches(np.minimum(a - alone_a, b - alone_b), a, b, num, den)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _unsigned(values: pa.Array) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


def sets_of(
    docs: DataFrame, id_col: str, text_col: str, width: int, bands: Bands, folder: str | None = None
) -> DataFrame:
    """``doc``, ``n``, ``node`` and the ``keys``, with the ``band`` and ``more`` of ``part_keys``; with a ``folder``
    instead the place (``uri``, ``at``) of the bitmap and the sorted n-grams in its files."""
    extra = ["keys", "band", "more"] if folder is None else ["uri", "at"]

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray]]:
        for row, stop, t in tx.texts(batch.column(1), lower=True):
            grams, sizes = document_sets(t, width)
            columns = [
                batch.column(0).slice(row, stop - row),
                pa.array(sizes, pa.int64()),
                pa.array(_node(grams, sizes).view(np.int64), pa.int64()),
            ]
            yield columns, grams, sizes

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns, grams, sizes in parts(batch):
                keys, counts, more = part_keys(grams, sizes, bands)
                columns.append(tx.list_array(keys.view(np.int64), counts, pa.int64()))
                columns.append(pa.array(bands.of(sizes), pa.int64()))
                columns.append(tx.list_array(more.ravel(), np.full(len(sizes), more.shape[1]), pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "node", *extra])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[pa.Array], np.ndarray]] = []
        data: list[bytes] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            uri = store.write(folder, ".grams", b"".join(data))
            for columns, at in held:
                place = [pa.array([uri] * len(at), pa.string()), pa.array(at, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *place], ["doc", "n", "node", *extra])

        for batch in batches:
            for columns, grams, sizes in parts(batch):
                block, starts = _stored(grams, sizes)
                held.append((columns, size + starts))
                data.append(block)
                size += len(block)
                if size >= GRAM_FILE_BYTES:
                    yield from close()
                    held, data, size = [], [], 0
        if held:
            yield from close()

    id_type = docs.schema[id_col].dataType.simpleString()
    kinds = {"keys": "array<long>", "band": "long", "more": "array<long>", "uri": "string", "at": "long"}
    schema = f"doc {id_type}, n long, node long, " + ", ".join(f"{c} {kinds[c]}" for c in extra)
    read = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return read.mapInArrow(keyed if folder is None else written, schema)


def _stored(grams: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """For each set its bitmap, then its n-grams; and where each begins."""
    bits, words = bitmaps(grams, sizes)
    length = words + sizes
    start = np.cumsum(length) - length
    out = np.empty(int(length.sum()), "<u8")
    owner = np.repeat(np.arange(len(sizes)), words)
    out[np.arange(len(bits)) - (np.cumsum(words) - words)[owner] + start[owner]] = bits
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out[np.arange(len(grams)) - (np.cumsum(sizes) - sizes)[owner] + (start + words)[owner]] = grams
    return out.tobytes(), 8 * start


class Sets:
    """Bitmaps and n-grams of sets by range reads of their files; the latest ones stay in memory."""

    def __init__(self):
        self.files: dict[str, store.Ranges] = {}
        self.sets: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        self.held = 0

    def of(self, uri: str, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.sets.get((uri, at))
        if found is None:
            if uri not in self.files:
                if len(self.files) >= 64:
                    self.files.pop(next(iter(self.files))).close()
                self.files[uri] = store.Ranges(uri)
            words = int(bitmap_words(np.array([n]))[0])
            data = np.frombuffer(self.files[uri].read(at, 8 * (words + n)), "<u8")
            found = data[:words], data[words:]
            while self.sets and self.held + n > CACHED_GRAMS:
                self.held -= len(self.sets.pop(next(iter(self.sets)))[1])
            self.sets[uri, at] = found
            self.held += n
        return found


def _sides(pairs: DataFrame, sets: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    for side in "ab":
        own = sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", *[f"{c}_{side}" for c in columns for side in "ab"])


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that are linked: their bitmaps do not rule it out, and the intersection of their sorted
    arrays shows it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Sets()
        for batch in batches:
            keep = []
            for n_a, n_b, uri_a, uri_b, at_a, at_b in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                linked = reaches(min(n_a, n_b), n_a, n_b, num, den)
                if linked:
                    (bits_a, grams_a), (bits_b, grams_b) = known.of(uri_a, at_a, n_a), known.of(uri_b, at_b, n_b)
                    width = min(len(bits_a), len(bits_b))
                    linked = _can_reach(folded(bits_a, width), folded(bits_b, width), n_a, n_b, num, den) and reaches(
                        _overlap(grams_a, grams_b), n_a, n_b, num, den
                    )
                keep.append(bool(linked))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    # Pairs with one pivot follow each other, so its set is read once.
    return _sides(pairs, sets, ("n", "uri", "at")).sortWithinPartitions("b", "a").mapInArrow(run, "a long, b long")


class _Forest:
    """Union-find over the rows of a tile; rows of one root are joined from the start."""

    def __init__(self, roots: np.ndarray):
        self.of = np.unique(roots, return_inverse=True)[1]

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        return others[self.of[others] != self.of[i]]

    def join(self, i: int, j: int) -> bool:
        """Whether the two were apart."""
        own, other = self.of[i], self.of[j]
        if own == other:
            return False
        self.of[self.of == other] = own
        return True


def _tile_links(rows: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links of a tile that join what is apart so far: a spanning forest of them."""
    rows = rows.sort_values(["n", "node"], ignore_index=True)
    sizes, nodes = rows["n"].to_numpy(), rows["node"].to_numpy()
    forest = _Forest(rows["root"].to_numpy())
    # Sets of like sizes have like widths; the narrowest of the tile is used for all.
    width = int(bitmap_words(sizes).min(initial=1 << 40))
    files, ats = rows["uri"].tolist(), rows["at"].tolist()
    known = Sets()
    own = lambda i: known.of(files[i], ats[i], int(sizes[i]))
    bits = np.stack([folded(own(i)[0], width) for i in range(len(rows))])
    links = []
    for i in range(len(rows)):
        stop = int(np.searchsorted(sizes, sizes[i] * den // num, "right"))
        others = forest.apart(i, np.arange(i + 1, stop))
        others = others[_can_reach(bits[i], bits[others], sizes[i], sizes[others], num, den)]
        for j in others.tolist():
            if forest.of[i] != forest.of[j] and reaches(_overlap(own(i)[1], own(j)[1]), sizes[i], sizes[j], num, den):
                forest.join(i, j)
                links.append((nodes[i], nodes[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _with_roots(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("root", F.col("node"))
    return members.join(roots.select(F.col("node").alias("_n"), F.col("root").alias("_r")), F.col("node") == F.col("_n"), "left").select(
        *members.columns, F.coalesce("_r", "node").alias("root")
    )


def _band() -> Column:
    return F.shiftrightunsigned("key", _BAND_SHIFT)


def _needed(members: DataFrame) -> DataFrame:
    """``key`` and ``node`` without the ``more`` most frequent keys of each node and band.

    Linked sets share ``more`` keys and one.  All order keys alike, so the rarest that they share stays in both;
    what only frequent n-grams bring together falls apart.
    """
    frequent = Window.partitionBy("node", _band()).orderBy(F.desc("_c"), "key")
    return members.withColumn("_rank", F.dense_rank().over(frequent)).where("_rank > more").select("key", "node")


def _apart(members: DataFrame) -> DataFrame:
    """Members of key groups that more than one component shares."""
    groups = members.groupBy("key").agg(
        F.min("root").alias("_low"), F.max("root").alias("_high"), F.min(F.struct(F.hash("node", F.lit(5)), "node")).alias("_p")
    ).where("_low <> _high").select(F.col("key").alias("_key"), F.col("_p.node").alias("_pivot"))
    return members.join(groups, F.col("key") == F.col("_key")).drop("_key")


def _pivot_pairs(apart: DataFrame) -> DataFrame:
    """Each member with the pivot of each of its groups, but those that are joined already."""
    roots = apart.where(F.col("node") == F.col("_pivot")).select(F.col("key").alias("_k"), F.col("root").alias("_pr")).distinct()
    return (
        apart.where(F.col("node") != F.col("_pivot")).join(roots, F.col("key") == F.col("_k")).where("root <> _pr")
        .select(F.col("node").alias("a"), F.col("_pivot").alias("b")).distinct()
    )


def _fields(members: DataFrame, keep) -> DataFrame:
    """``node``, ``root`` and ``field`` of what is apart: groups that share a component are one field."""
    lowest = members.groupBy("key").agg(F.min("root").alias("_low")).withColumnRenamed("key", "_key")
    edges = members.join(lowest, F.col("key") == F.col("_key")).where("root <> _low").select(
        F.col("_low").alias("a"), F.col("root").alias("b")
    ).distinct()
    fields = components(edges, keep=keep).select(F.col("node").alias("_n"), F.col("root").alias("field"))
    return members.select("node", "root").distinct().join(fields, F.col("root") == F.col("_n")).drop("_n")


def _tiles(fields: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links across components inside fields, block against block of like sizes."""
    # Classes are narrower than the threshold, so links reach the next class at most.
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num))).cast("long")
    sized = fields.join(sets.select("node", "n", "uri", "at"), "node").withColumn("c", size_class)
    needed = F.greatest(F.ceil(F.sum("_m") / F.lit(TILE_ROWS)), F.ceil(F.sum("_g") / F.lit(TILE_GRAMS))).cast("long")
    told = sized.groupBy("field", "c").agg(F.count(F.lit(1)).alias("_m"), F.sum("n").alias("_g"))
    small = told.groupBy("field").agg(needed.alias("_all"))
    own = told.groupBy("field", "c").agg(needed.alias("_own"))
    blocks = own.join(small, "field")
    for side, step in (("_down", -1), ("_up", 1)):
        beside = own.select("field", (F.col("c") - step).alias("c"), F.col("_own").alias(side))
        blocks = blocks.join(beside, ["field", "c"], "left")
    placed = sized.join(blocks, ["field", "c"]).withColumn("share", F.pmod(F.xxhash64("node", F.lit(3)), F.col("_own")))

    def tiles(count: str, at: Callable) -> Column:
        none = F.array().cast("array<struct<c:bigint,up:int,s:bigint,t:bigint>>")
        return F.coalesce(F.transform(F.sequence(F.lit(0).cast("long"), F.col(count) - 1), at), none)

    def tile(c: Column, up: int, s: Column, t: Column) -> Column:
        return F.struct(c.cast("long").alias("c"), F.lit(up).alias("up"), s.cast("long").alias("s"), t.cast("long").alias("t"))

    # Tile (c, s, t): shares s and t of class c, and share s of class c with share t of class c + 1.
    share, c, zero = F.col("share"), F.col("c"), F.lit(0)
    several = F.concat(
        tiles("_own", lambda t: tile(c, 0, F.least(share, t), F.greatest(share, t))),
        tiles("_up", lambda t: tile(c, 1, share, t)),
        tiles("_down", lambda t: tile(c - 1, 1, t, share)),
    )
    # A small field is one tile.
    dealt = placed.withColumn("tile", F.explode(F.when(F.col("_all") == 1, F.array(tile(zero, 0, zero, zero))).otherwise(several)))
    rows = dealt.select("field", "tile.*", "node", "root", "n", "uri", "at")
    return rows.groupBy("field", "c", "up", "s", "t").applyInPandas(
        lambda group: _tile_links(group, num, den), "a long, b long"
    )


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    threshold: tuple[int, int] = (9, 10),
) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id``, the smallest id that links lead to."""
    num, den = threshold
    scratch = ship.Scratch(docs.sparkSession)
    bands = Bands(num, den)
    keyed = scratch.keep(sets_of(docs, id_col, text_col, width, bands))
    # One document stands for all of its node; repeated ids may leave a few more.
    copied = keyed.where("n > 0").groupBy("node").agg(F.min("doc").alias("_least"), F.count(F.lit(1)).alias("_c")).where("_c > 1")
    copies = keyed.select("doc", "node").join(copied.select(F.col("node").alias("_node"), "_least"), F.col("node") == F.col("_node")).where(
        "doc <> _least").select(F.col("doc").alias("_copy")).distinct()
    standing = keyed.join(ship.measured(copies, keep=scratch.keep), F.col("doc") == F.col("_copy"), "left_anti")
    exploded = standing.select(F.explode("keys").alias("key"), "node", "band", "more").select(
        "key", "node", F.get("more", (_band() - F.col("band")).cast("int")).alias("more"), F.col("key").bitwiseAND(_KEY_BITS).alias("_low")
    )
    # Most keys occur once: they go by their lower bits alone, which tell nearly all apart.
    shared = exploded.groupBy("_low").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
    members = _needed(exploded.join(ship.measured(shared, KEY_ROWS, scratch.keep), "_low"))
    apart = scratch.keep(_apart(_with_roots(members, None)))

    # The sets of those nodes alone are built once more, from one document of each.
    nodes = apart.select(F.col("node").alias("_node")).distinct()
    chosen = keyed.select("doc", "node").join(nodes, F.col("node") == F.col("_node")).groupBy("node").agg(F.min("doc").alias("_doc")).select("_doc")
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    read = texts.join(ship.measured(chosen, keep=scratch.keep), "_doc", "left_semi")
    sets = scratch.keep(sets_of(read, "_doc", "_text", width, bands, f"{scratch.folder}/grams").drop("doc"))

    links = roots = None
    for _ in range(PIVOT_ROUNDS):
        if not apart.limit(1).count():
            break
        found = scratch.keep(_linked(_pivot_pairs(apart), sets, num, den))
        links = found if links is None else links.unionByName(found)
        roots = scratch.keep(components(links, keep=scratch.keep))
        # A pivot has met all of its group.
        members = apart.where(F.col("node") != F.col("_pivot")).select("key", "node")
        apart = scratch.keep(_apart(_with_roots(members, roots)))
    fields = scratch.keep(_fields(apart, scratch.keep))
    found = scratch.keep(_tiles(fields, sets, num, den))
    if found.limit(1).count():
        links = found if links is None else links.unionByName(found)
        roots = scratch.keep(components(links, keep=scratch.keep))

    flat = keyed.select("doc", "n", "node")
    rooted = _with_roots(flat, roots)
    # Empty documents and null ids are alone.
    least = rooted.where("n > 0").groupBy("root").agg(F.min("doc").alias("_least"))
    named = rooted.join(least.withColumnRenamed("root", "_root"), (F.col("root") == F.col("_root")) & (F.col("n") > 0), "left")
    return scratch.result(
        named.select(
            F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("_least", "doc").alias("component_id")
        )
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, threshold: tuple[int, int] = (9, 10)
) -> DataFrame:
    """``docs`` with one row of each class alone; documents without words all stay.

    The row has the smallest id, null ids behind all others; of several texts with this id
    that of the smallest hash stays, and of rows equal in id and text any one.
    """
    row, name = ship.free_name(docs, "_row"), ship.free_name(docs, "_same")
    key = F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"))
    numbered = docs.select(key.alias(row), F.col(text_col).alias("_text"))
    found = classes(numbered, row, "_text", width, threshold).where("n_shingles > 0")
    dropped = ship.measured(found.where(F.col(row) != F.col("component_id")).select(F.col(row).alias(name)).distinct())
    left = docs.join(dropped, key == F.col(name), "left_anti")
    chosen = found.where(F.col(row) == F.col("component_id"))
    again = ship.measured(chosen.groupBy(F.col(row).alias(name)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name))
    if not again.limit(1).count():
        return left
    once = left.join(again, key == F.col(name), "left_semi").dropDuplicates([id_col, text_col])
    return left.join(again, key == F.col(name), "left_anti").unionByName(once)
