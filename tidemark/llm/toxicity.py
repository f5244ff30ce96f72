"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed character n-grams and of itself, so an unseen spelling
shares most of its vectors with the spellings the model knows.  The vectors are averaged
over a word, the words over the document, and a linear softmax reads the average; the
vectors and the softmax are trained together, in numpy, on a bounded sample of labelled
documents.  The buckets of the sample are counted by the tasks, over whole texts, and written
to files; the driver reads numbers alone, at most ``SAMPLE_POSITIVE + SAMPLE_NEGATIVE`` rows of ``FEATURES``
buckets.  Scoring is linear in the words, so it needs one number per bucket, and whole
texts of any length are scored where they lie.

Defined results: words are A-Z lower-cased; null and empty texts get the score of an average
of no words, which is the bias alone; a null label is no label, the same label given twice
counts once, an id with both labels counts for each; of several texts of one id the one of
the smallest hash is learnt from, all are scored; without positive or negative labels the
score is the known share (0 when there are no labels at all).  Extra columns stay outside,
whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ship, store
from tidemark.llm import text as tx

#: Most labelled documents of each class that are learnt from.
SAMPLE_POSITIVE = 2_000
SAMPLE_NEGATIVE = 4_000
#: Most buckets of a sampled document that are learnt from, the heaviest ones of its whole text.
FEATURES = 8_192
BUCKETS = 1 << 18
DIMENSIONS = 8
GRAMS = (3, 4, 5)
#: A bucket in n documents of the sample counts n / (n + SHRINK), so that rare ones pull little.
SHRINK = 8.0
EPOCHS = 6
BATCH = 64
RATE = 0.02
#: A shared factor of all averages, which only conditions the training.
SCALE = 50.0
#: Words without a pull that every document is given, so that a few words prove little.
PRIOR_WORDS = 20
#: How fast unused vectors shrink.
DECAY = 0.5


def subwords(t: tx.Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a slice: their buckets flat, how many each has, and the word of each place.

    Words keep their punctuation only inside: marks at both ends are cut off first.
    """
    start, end = _trimmed(t)
    hashes = t.span_hashes(start, end)
    distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    start, end = start[first], end[first]
    # Each word in angle brackets, one after the other.
    length = end - start + 2
    border = np.concatenate([[0], np.cumsum(length)])
    data = np.empty(border[-1], np.uint8)
    if len(distinct):
        place = np.repeat(start - 1 - border[:-1], length) + np.arange(border[-1])
        data[:] = t.data[np.clip(place, 0, len(t.data) - 1)]
        data[border[:-1]] = 60
        data[border[1:] - 1] = 62
    owners = [np.arange(len(distinct))]
    grams = [distinct]
    whole = np.concatenate([border[1:], [border[-1]]])
    word_of = np.repeat(np.arange(len(distinct)), length)
    for n in GRAMS:
        at = np.arange(len(data))
        at = at[at + n <= whole[word_of]] if len(data) else at
        grams.append(tx.mix_with(tx.span_hashes(tx._BYTE_VALUES[data], at, at + n), n))
        owners.append(word_of[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = (np.concatenate(grams)[order] % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.bincount(owner, minlength=len(distinct)), back


_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in ".,;:!?\"'()[]{}"]] = True


def _trimmed(t: tx.Text) -> tuple[np.ndarray, np.ndarray]:
    """Word borders without marks at the ends; a word of marks alone stays whole."""
    solid = np.flatnonzero(~_MARKS[t.data] & t.is_word)
    left = np.searchsorted(solid, t.start)
    right = np.searchsorted(solid, t.end) - 1
    filled = right >= left
    start, end = t.start.copy(), t.end.copy()
    start[filled] = solid[left[filled]]
    end[filled] = solid[right[filled]] + 1
    return start, end


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    border = np.concatenate([[0], np.cumsum(lengths)])
    return total[border[1:]] - total[border[:-1]]


@dataclass
class Model:
    """The trained model as it is used: the pull of each bucket, the bias."""

    pull: np.ndarray
    bias: float

    def logits(self, t: tx.Text) -> np.ndarray:
        buckets, lengths, back = subwords(t)
        word = _sums(self.pull[buckets], lengths) / np.maximum(lengths, 1)
        total = t.per_doc_of_words(word[back])
        return SCALE * total / (t.words_per_doc() + PRIOR_WORDS) + self.bias

    def scores(self, t: tx.Text) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(t), -60, 60)))


def features(t: tx.Text) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The buckets of each document and their weights, at most ``FEATURES`` of them."""
    flat, lengths, back = subwords(t)
    first = np.cumsum(lengths) - lengths
    per_doc = t.words_per_doc()
    for d in range(t.docs):
        words, times = np.unique(back[t.first[d] : t.first[d + 1]], return_counts=True)
        n = lengths[words]
        place = np.repeat(first[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        share = np.repeat(SCALE * times / (n * (per_doc[d] + PRIOR_WORDS)), n)
        own, back_own = np.unique(flat[place], return_inverse=True)
        weight = np.bincount(back_own, share, len(own)).astype(np.float32)
        if len(own) > FEATURES:
            heavy = np.sort(np.lexsort((own, -weight))[:FEATURES])
            own, weight = own[heavy], weight[heavy]
        yield own.astype(np.int32), weight


def _packed(buckets: np.ndarray, weights: np.ndarray) -> bytes:
    """Features of one document: steps between buckets, weights of sixteen bits, compressed."""
    steps = np.diff(buckets, prepend=0).astype("<u4")
    return zstandard.ZstdCompressor(level=3).compress(steps.tobytes() + weights.astype("<f2").tobytes())


def _unpacked(data: bytes, held: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data) if held else b""
    return np.cumsum(np.frombuffer(raw, "<u4", held)), np.frombuffer(raw, "<f2", held, 4 * held)


#: Bytes of a file of features.
FEATURE_FILE_BYTES = 16 << 20
#: Features that are worked on at once where all are.
_STRETCH = 1 << 20


def train(
    buckets: np.ndarray, weights: np.ndarray, border: np.ndarray, toxic: np.ndarray, share: float,
    epochs: int = EPOCHS, seed: int = 7,
) -> Model:
    """Vectors and softmax together, by Adam on small batches.

    Document ``i`` has the buckets and weights from ``border[i]`` to ``border[i + 1]``; both arrays are
    changed.
    ``share`` is the share of positive labels outside the sample; classes are weighted to it.
    """
    n = len(toxic)
    positive = int(toxic.sum())
    if not positive or positive == n:
        edge = 0.0 if not positive else 1.0
        return Model(np.zeros(BUCKETS), np.log((edge + 1e-6) / (1 - edge + 1e-6)))
    share = min(max(share, 1e-3), 1 - 1e-3)
    stretches = [slice(a, a + _STRETCH) for a in range(0, len(buckets), _STRETCH)]
    held_by = np.zeros(BUCKETS, np.int64)
    for own in stretches:
        held_by += np.bincount(buckets[own], minlength=BUCKETS)
    trust = (held_by / (held_by + SHRINK)).astype(np.float32)
    names = np.flatnonzero(held_by)
    column = np.zeros(BUCKETS, np.int32)
    column[names] = np.arange(len(names))
    for own in stretches:  # in place: the arrays are the larger part of the driver's memory
        weights[own] *= trust[buckets[own]]
        buckets[own] = column[buckets[own]]
    flagged = np.zeros(len(names), bool)
    number = np.zeros(len(names), np.int64)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (len(names), DIMENSIONS)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    loss_weight = np.where(toxic, share * n / positive, (1 - share) * n / (n - positive)).astype(np.float32)
    slow = [np.zeros_like(vectors), np.zeros_like(soft), np.zeros_like(bias)]
    fast = [np.zeros_like(vectors), np.zeros_like(soft), np.zeros_like(bias)]
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            docs = order[at : at + BATCH]
            size = border[docs + 1] - border[docs]
            place = np.repeat(border[docs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            owner = np.repeat(np.arange(len(docs)), size)
            flagged[:] = False
            flagged[buckets[place]] = True
            used = np.flatnonzero(flagged)
            number[used] = np.arange(len(used))
            local, weight = number[buckets[place]], weights[place]
            own = vectors[used]
            hidden = _by_owner(own[local] * weight[:, None], owner, len(docs))
            out = hidden @ soft + bias
            out -= out.max(axis=1, keepdims=True)
            p = np.exp(out)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(docs)), toxic[docs].astype(int)] -= 1
            p *= loss_weight[docs, None] / len(docs)
            back = (p @ soft.T)[owner] * weight[:, None]
            grads = (_by_owner(back, local, len(used)), hidden.T @ p, p.sum(axis=0))
            step += 1
            lift = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for i, (value, grad) in enumerate(zip((own, soft, bias), grads, strict=True)):
                row = used if i == 0 else slice(None)
                first = 0.9 * slow[i][row] + 0.1 * grad
                second = 0.999 * fast[i][row] + 0.001 * grad * grad
                slow[i][row], fast[i][row] = first, second
                value -= rate * lift * first / (np.sqrt(second) + 1e-8)
            own *= 1 - rate * DECAY
            vectors[used] = own
    pull = np.zeros(BUCKETS)
    pull[names] = trust[names] * (vectors @ (soft[:, 1] - soft[:, 0]))
    return Model(pull, float(bias[1] - bias[0]))


def _by_owner(rows: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Sums of the rows of each owner."""
    return np.stack([np.bincount(owner, rows[:, k], owners) for k in range(rows.shape[1])], axis=1).astype(np.float32)


def sample(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """What :func:`train` learns from: at most ``SAMPLE_*`` documents of each class, in hash order."""
    known = (
        labels.select(F.col(id_col), F.col(label_col).cast("int")).toDF(id_col, "_label")
        .where(F.col(id_col).isNotNull() & F.col("_label").isin(0, 1))
        .where(learn)
        .select(F.col(id_col).alias("_id"), F.col("_label").alias("_y")).distinct()
    )
    counts = {r._y: r["count"] for r in known.groupBy("_y").count().collect()}
    chosen = None
    for y, most in {0: SAMPLE_NEGATIVE, 1: SAMPLE_POSITIVE}.items():
        part = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    # The chosen ids are at most the two limits together.
    read = texts.join(F.broadcast(chosen), "_id").select("_text", "_id", "_y", F.xxhash64("_text").alias("_hash"))
    id_type = read.schema["_id"].dataType.simpleString()

    scratch = ship.Scratch(docs.sparkSession)
    folder = scratch.folder
    names = ["_id", "_y", "_hash", "held", "uri", "at", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[list[pa.Array], list[int], list[bytes]]] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            uri = store.write(folder, ".features", b"".join(b for *_, packed in waiting for b in packed))
            at = 0
            for columns, held, packed in waiting:
                lengths = np.array([len(b) for b in packed], np.int64)
                place = [pa.array(held, pa.int32()), pa.array([uri] * len(held), pa.string()), pa.array(at + np.cumsum(lengths) - lengths)]
                yield pa.RecordBatch.from_arrays([*columns, *place, pa.array(lengths)], names)
                at += int(lengths.sum())

        for batch in batches:
            for row, stop, t in tx.texts(batch.column(0), lower=True):
                own = list(features(t))
                packed = [_packed(b, w) for b, w in own]
                waiting.append(([batch.column(i).slice(row, stop - row) for i in (1, 2, 3)], [len(b) for b, _ in own], packed))
                size += sum(map(len, packed))
                if size >= FEATURE_FILE_BYTES:
                    yield from close()
                    waiting, size = [], 0
        if waiting:
            yield from close()

    # The driver gets the places of the features from Spark, and the features from their files.
    counted = read.mapInArrow(run, f"_id {id_type}, _y int, _hash long, held int, uri string, at long, length long")
    one = F.min(F.struct("_hash", *names[3:])).alias("one")
    rows = counted.groupBy("_id", "_y").agg(one).select(F.xxhash64("_id").alias("at"), "_id", "_y", "one").collect()
    rows.sort(key=lambda r: (r["at"], r["_id"], r["_y"]))
    border = np.concatenate([[0], np.cumsum([r["one"]["held"] for r in rows], dtype=np.int64)]).astype(np.int64)
    buckets, weights = np.empty(border[-1], np.int32), np.empty(border[-1], np.float32)
    places = zip(rows, border.tolist(), border[1:].tolist())
    for uri, own in itertools.groupby(sorted(places, key=lambda p: (p[0]["one"]["uri"], p[1])), key=lambda p: p[0]["one"]["uri"]):
        file = store.Ranges(uri)
        for r, a, b in own:
            buckets[a:b], weights[a:b] = _unpacked(file.read(r["one"]["at"], r["one"]["length"]), b - a)
        file.close()
    scratch.remove()
    toxic = np.array([r["_y"] == 1 for r in rows], bool)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return buckets, weights, border, toxic, share


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Model:
    """A model of the labelled documents for which ``learn`` (over ``id_col``) holds."""
    return train(*sample(docs, labels, F.lit(True) if learn is None else learn, id_col, text_col, label_col))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns of ``keep`` and ``score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 8 bytes a bucket
    names = [id_col, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(0), lower=True):
                rest = [batch.column(i + 1).slice(row, stop - row) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(own.scores(t), pa.float64())], [*names, "score"])

    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return docs.select(F.col(text_col).alias("_text"), *names).mapInArrow(run, f"{fields}, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for row, stop, t in tx.texts(batch.column(at), lower=True):
                yield batch.slice(row, stop - row).filter(pa.array(own.scores(t) < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
