"""Near-duplicate classes against a comparison of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tidemark.llm import jaccard, ship, store
from tidemark.llm import text as tx
from tidemark.llm.components import components


def _set(text, width=3):
    lower = bytes(range(65, 91)), bytes(range(97, 123))
    w = (text or "").encode().translate(bytes.maketrans(*lower)).split()
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def _classes(rows, num=9, den=10, width=3):
    sets = {d: _set(t, width) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - shared
            if sets[a] and sets[b] and shared * den >= num * union:
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {d: (len(sets[d]), root(d)) for d in ids}


def _edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def _corpus(seed, groups):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n ", "one", "One", "one two", "ONE two", "one two three"]
    common = [rng.choice(vocabulary) for _ in range(12)]
    for _ in range(groups):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([5, 9, 12, 20, 40, 70, 150, 400, 900]))]
        if rng.random() < 0.5:
            words = words + common
        texts.append(" ".join(words))
        # Chains of edits: neighbours link, ends need not.
        for _ in range(rng.randrange(8)):
            words = _edited(rng, words, rng.randrange(1, 2 + len(words) // 40)).split()
            texts.append(" ".join(words))
            if rng.random() < 0.3:
                texts.append(texts[-1].upper())
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(d, t) for d, t in zip(order, texts, strict=True)]


def _found(spark, rows, **options):
    ship.prepare(spark)
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, node int, key string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(df, **options).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, seed):
    rows = _corpus(seed, 60)
    assert _found(spark, rows) == _classes(rows)


def test_other_width_and_threshold(spark):
    rows = _corpus(3, 40)
    assert _found(spark, rows, width=5, threshold=(4, 5)) == _classes(rows, 4, 5, 5)


def test_large_group_of_near_copies_uses_tiles(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"v{rng.randrange(300)}" for _ in range(60)]
    rows = [(i, _edited(rng, base, rng.randrange(1, 4))) for i in range(300)]
    monkeypatch.setattr(jaccard, "TILE_ROWS", 16)
    assert _found(spark, rows) == _classes(rows)


def test_unlike_sets_share_no_keys():
    """Parts that are empty in both sides bring no sets together that hold n-grams enough."""
    rng = np.random.default_rng(7)
    sizes = rng.integers(243, 365, 400)
    grams = rng.integers(0, 1 << 62, int(sizes.sum())).astype(np.uint64)
    keys = jaccard.part_keys(grams, sizes, jaccard.Bands(4, 5))[0]
    assert len(np.unique(keys)) >= len(keys) - 5


@pytest.mark.parametrize("num, den", [(9, 10), (4, 5), (1, 2)])
def test_linked_sets_share_more_keys_than_are_left_out(num, den):
    rng = np.random.default_rng(8)
    bands = jaccard.Bands(num, den)
    edges = [int(u) + d for u in bands.upper[:14] for d in (-1, 0, 1)]
    for a in [1, 2, 3, 4, 6, 7, 9, 12, 15, 29, 40, *edges, *rng.integers(1, 3000, 60).tolist()]:
        for b in {a, a + a // 20, min(a * den // num, a + rng.integers(0, a + 1)), a * den // num}:
            shared = -(-num * (a + b) // (num + den))
            if not 0 < a <= b or shared > a or shared == b:
                continue
            assert jaccard.reaches(shared, a, b, num, den)
            grams = rng.integers(0, 1 << 62, a + b - shared).astype(np.uint64)
            sets = np.concatenate([grams[:a], grams[a - shared :]])
            keys, counts, more = jaccard.part_keys(sets, np.array([a, b]), bands)
            common = np.intersect1d(keys[: counts[0]], keys[counts[0] :])
            step = int(bands.of(np.array([b]))[0] - bands.of(np.array([a]))[0])
            assert len(common) > max(more[0, step], more[1, 0])


def test_common_lines_do_not_merge_fields(spark, monkeypatch):
    """Groups of near sets that a common passage bridges are searched one by one."""
    rng = random.Random(9)
    common = [f"c{i}" for i in range(40)]
    rows = []
    for group in range(30):
        base = [f"g{group}w{i}" for i in range(rng.randrange(230, 330))]
        for _ in range(6):
            words = _edited(rng, base, rng.randrange(5, 16)).split()
            rows.append((len(rows), " ".join(words + common)))
    fields = []
    found = jaccard._fields

    def told(*args):
        out = found(*args)
        fields.extend(out.groupBy("field").count().toPandas()["count"])
        return out

    monkeypatch.setattr(jaccard, "_fields", told)
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 1)
    assert _found(spark, rows, width=5, threshold=(4, 5)) == _classes(rows, 4, 5, 5)
    assert max(fields) <= 18


def test_tiles_return_a_spanning_forest(tmp_path):
    rng = random.Random(6)
    base = [f"v{rng.randrange(400)}" for _ in range(120)]
    data, offsets = tx.buffers(pa.array([_edited(rng, base, rng.randrange(0, 3)) for _ in range(200)]))
    grams, sizes = jaccard.document_sets(tx.Text(data, offsets, lower=True), 3)
    parts = np.split(grams, np.cumsum(sizes)[:-1])
    data, at = jaccard._stored(grams, sizes)
    uri = store.write(f"file://{tmp_path}", ".grams", data)
    rows = pd.DataFrame({"node": np.arange(200), "root": np.arange(200) % 190, "n": sizes, "uri": uri, "at": at})
    links = jaccard._tile_links(rows, 9, 10)
    assert 0 < len(links) < 190
    for a, b in links.itertuples(index=False):
        assert jaccard.reaches(len(set(parts[a]) & set(parts[b])), sizes[a], sizes[b], 9, 10)


def test_bitmaps_never_rule_a_link_out():
    rng = np.random.default_rng(4)
    for n in (1, 5, 40, 300, 2000):
        for _ in range(30):
            both = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
            own = [np.unique(np.concatenate([both, rng.integers(0, 1 << 60, rng.integers(0, 1 + n // 8)).astype(np.uint64)])) for _ in "ab"]
            sizes = np.array([len(x) for x in own])
            bits, words = jaccard.bitmaps(np.concatenate(own), sizes)
            least = int(words.min())
            pair = [jaccard.folded(x, least) for x in np.split(bits, [words[0]])]
            if jaccard.reaches(len(both), *sizes, 9, 10):
                assert jaccard._can_reach(*pair, *sizes, 9, 10)


def test_empty_table(spark):
    assert _found(spark, []) == {}


def test_components_of_a_path(spark):
    n = 40
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(n)}
