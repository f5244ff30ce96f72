"""Fingerprints, filter audit and token alignment against plain versions, on odd rows and whole tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import alignment, audit, queries, ship, winnowing
from tidemark.llm import text as tx

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# Fingerprints


def plain_choices(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    if not text:
        return []
    hashes = [zlib.crc32(text[i : i + gram].encode("utf-32-be")) for i in range(max(1, len(text) - gram + 1))]
    out = []
    for s in range(max(1, len(hashes) - window + 1)):
        least = min(hashes[s : s + window])
        at = max(i for i, h in enumerate(hashes[s : s + window], s) if h == least)
        if not out or out[-1][1] != at:
            out.append((least, at))
    return out


def plain_edited(rows):
    """Text, edited text and next text by id; ids are distinct."""
    order = sorted(rows, reverse=True)
    out = {}
    for (d, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        out[d] = text, text[: len(text) - half] + after[:half], after
    return out


def _chosen(choices):
    return [(c >> 31, winnowing._LOW - (c & winnowing._LOW)) for c in choices]


def _likeness(a, b):
    a, b = ({h for h, _ in plain_choices(x)} for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def _same_fingerprints(df, rows, **options):
    expected = plain_edited([(d, t or "") for d, t in rows])
    got = winnowing.compare_edited(df, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        text, edited, after = expected[r.doc_id]
        assert (r.n_chars, r.edited_text) == (len(text), edited)
        assert _chosen(r.chosen) == plain_choices(text) and _chosen(r.edited_chosen) == plain_choices(edited)
        assert r.near_edited == pytest.approx(_likeness(text, edited)) and r.near_next == pytest.approx(_likeness(text, after))


def test_fingerprints_of_odd_rows(odd, none, odd_rows, monkeypatch):
    monkeypatch.setattr(winnowing, "RANGE_ROWS", 3)
    monkeypatch.setattr(winnowing, "BLOCK", 1_000)
    kept = [(d, t) for d, t in odd_rows if len(t or "") < 20_000]
    _same_fingerprints(odd.where(F.coalesce(F.length("text"), F.lit(0)) < 20_000), kept)
    assert winnowing.compare_edited(none).count() == 0 and winnowing.fingerprints(none).count() == 0


@pytest.mark.parametrize("rows", [[(3, "the only row " * 9)], [(i, "ab c" * i) for i in range(40)], [(i, "z" * 60) for i in (9, -4, 70)]])
def test_fingerprints_of_short_and_equal_texts(spark, rows):
    ship.prepare(spark)
    _same_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_neighbours_with_null_and_repeated_ids(spark, monkeypatch):
    """Null ids come last, rows of one id follow each other by text; every row has one neighbour."""
    monkeypatch.setattr(winnowing, "RANGE_ROWS", 2)
    rows = [(5, "b"), (5, "a"), (None, "n"), (9, "z"), (1, "q"), (7, "y"), (3, None), (2, "w"), (5, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r._id, r._text, r.next_text) for r in winnowing.with_next(df, "doc_id", "text").collect())
    order = [(9, "z"), (7, "y"), (5, "a"), (5, "a"), (5, "b"), (3, ""), (2, "w"), (1, "q"), (None, "n")]
    assert got == Counter((d, t, after) for (d, t), (_, after) in zip(order, order[1:] + order[:1], strict=True))
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], "doc_id long, text string")
    assert Counter((r._text, r.next_text) for r in winnowing.with_next(nulls, "doc_id", "text").collect()) == Counter([("a", "b"), ("b", "a")])


def test_shared_passages_leave_a_common_hash(spark):
    """The guarantee: gram + window - 1 common code points."""
    rng = random.Random(4)
    noise = lambda n: "".join(chr(rng.randrange(0x20, 0x3000)) for _ in range(n))
    passage = noise(winnowing.GRAM + winnowing.WINDOW - 1)
    rows = [(i, noise(rng.randrange(300)) + passage + noise(rng.randrange(300))) for i in range(30)]
    found = winnowing.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    shared = set.intersection(*({e.hash for e in r.fingerprint} for r in found))
    assert shared and all(any(e.hash in shared and passage.startswith(t[e.position]) or e.hash in shared for e in r.fingerprint) for r, (_, t) in zip(found, rows))


def test_fingerprints_run_no_python(spark, sf_dir):
    ship.prepare(spark)
    plan = queries.QUERIES["op11_winnowing"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Arrow", "Pandas", "SinglePartition", "CartesianProduct", "NestedLoop"):
        assert operator not in plan
    assert plan.count("Exchange") == 1


def test_bound_fingerprints(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    expected = plain_edited(list(texts.items()))
    rows = queries.QUERIES["op11_winnowing"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    by_text = defaultdict(set)
    for r in rows:
        text, edited, _ = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[text].add(r.fingerprint)
        by_text[edited].add(r.edited_fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    words = lambda found: " ".join(f"{h}:{p}" for h, p in found)
    for r in rows[::10]:
        assert (r.fingerprint, r.edited_fingerprint) == tuple(words(plain_choices(t)) for t in expected[r.doc_id][:2])


# Filter audit


def plain_audit(rows, labels):
    """rows: (id, text, source); the contract, read literally."""
    seen = {d: (any(q == 1 for i, q, _ in labels if i == d), any(t == 1 for i, _, t in labels if i == d)) for d, *_ in rows if d is not None}
    cells = defaultdict(Counter)
    for d, text, source in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": any(e is not None and (d is None or e < d) and (t or "") == text for e, t, _ in rows),
        }
        cells[source or ""][(frozenset(f for f in fails if fails[f]), *seen.get(d, (False, False)))] += 1
    out = {}
    for part, counts in cells.items():
        for order in itertools.permutations("ABCDE"):
            for step, own in enumerate(order, 1):
                before = set(order[: step - 1])
                pick = lambda test: sum(n for (f, *_), n in counts.items() if test(f))
                lost = lambda k: sum(n for (f, *l), n in counts.items() if own in f and not f & before and l[k])
                out[part, "".join(order), step] = [
                    pick(lambda f: not f & (before | {own})), pick(lambda f: own in f and not f & before),
                    pick(lambda f: own in f and f & before), pick(lambda f: f == {own}), lost(0), lost(1),
                ]
    for part in cells:
        for own in "ABCDE":
            total = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == own)
            for (p, o, s), v in out.items():
                if p == part and o[s - 1] == own:
                    v.append(total)
    return out


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _same_audit(docs, labels, rows, label_rows):
    got = audit.audit(docs, labels).collect()
    assert {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in got} == plain_audit(rows, label_rows)
    assert len(got) == 600 * len({r.part for r in got})


def test_audit_of_odd_rows(spark, odd, none, odd_rows):
    labels = [(d, d % 3 % 2, int(d % 4 == 0)) for d, _ in odd_rows] + [(3, 1, None), (3, None, 1), (None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = odd.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("a")).when(F.col("doc_id") % 3 == 1, F.lit("")))
    rows = [(d, t, {0: "a", 1: "", 2: None}[d % 3]) for d, t in odd_rows]
    _same_audit(docs, table, rows, labels)
    assert audit.audit(none.withColumn("source", F.lit("x")), table).count() == 0


def test_audit_with_null_and_repeated_ids(spark):
    ship.prepare(spark)
    rows = [(4, "same", "x"), (4, "same", "x"), (4, "same", "y"), (None, "same", "x"), (7, "same", None), (None, "alone", "x"), (None, "alone", "x"), (2, None, "y"), (3, "", "y")]
    labels = [(4, 1, 0), (7, 0, 1), (7, 0, 1)]
    _same_audit(
        spark.createDataFrame(rows, "doc_id long, text string, source string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels,
    )


def test_spans_of_equal_hash_are_verified(odd_rows, monkeypatch):
    """With a hash that says nothing, bytes alone tell words apart."""
    texts = [t or "" for _, t in odd_rows][:20] + ["x" * 70 + " " + "x" * 69 + "y " + "x" * 70, "abcdefgh abcdefgi abcdefgh a"]
    texts = [" ".join(t.split(" ")[:200]) for t in texts]
    expected = [len(set(re.findall("[^\x20\x09-\x0D]+", t))) for t in texts]
    data, offsets = tx.buffers(pa.array(texts))
    assert audit.Scan(data, offsets).distinct_words().tolist() == expected
    monkeypatch.setattr(tx, "span_hashes", lambda values, start, end: (end - start).astype(np.uint64) * np.uint64(0))
    assert audit.Scan(data, offsets).distinct_words().tolist() == expected


# Alignment


def _cut(ids, spans, cuts):
    """The ids of each group; a cut is an end of some token."""
    groups, ends = [[]], set(cuts)
    for i, (_, end) in zip(ids, spans):
        groups[-1].append(i)
        if end in ends:
            groups.append([])
    return groups[:-1]


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
    a.encode_special_tokens = True
    values = alignment._byte_values()
    docs, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(raw.decode(), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(values[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            docs.append(None)
            continue
        spans = []
        for sizes in (map(len, bytes_a), map(len, bytes_b)):
            ends = list(itertools.accumulate(sizes))
            spans.append(list(zip([0, *ends], ends)))
        links = Counter()
        j = 0
        for i, (start, end) in enumerate(spans[0]):
            while j and spans[1][j - 1][1] > start:
                j -= 1
            while j < len(spans[1]) and spans[1][j][0] < end:
                if spans[1][j][1] > start:
                    links[ids_a[i], ids_b[j]] += 1
                j += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = ["|".join(",".join(map(str, s)) for s in sides) for sides in zip(*(_cut(ids, side, cuts) for ids, side in zip((ids_a, ids_b), spans)))]
        docs.append((len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(links.keys())
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if d is None else (
            *d[:3], sum(d[3].values()), sum(n for p, n in d[3].items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in d[3].items()), d[4],
        )
        for d in docs
    ]


ALIGNED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("links", [alignment.BLOCK_LINKS, 500])
def test_alignment_of_odd_rows(odd, none, odd_rows, monkeypatch, links):
    """In one block, and in many small ones whose runs take several merges."""
    monkeypatch.setattr(alignment, "BLOCK_LINKS", links)
    monkeypatch.setattr(alignment, "SLICE_BYTES", alignment.SLICE_BYTES if links > 500 else 2_000)
    monkeypatch.setattr(alignment, "FAN_IN", 128 if links > 500 else 2)
    extra = [(100 + i, t) for i, t in enumerate(["\u2581 under", "two  blanks", "\x00 nul", "\ufb01 \U0001f600\u0301"])]
    docs = odd.select("doc_id", "text", "_text", "ids").unionByName(odd.sparkSession.createDataFrame(extra, "doc_id long, text string"), True)
    rows = odd_rows + extra
    got = {r.doc_id: tuple(r[c] for c in ALIGNED) for r in alignment.align(docs, FIRST, SECOND).collect()}
    assert got == dict(zip([d for d, _ in rows], plain_alignment([t for _, t in rows]), strict=True))
    assert alignment.align(none, FIRST, SECOND).count() == 0


def test_alignment_of_repeated_and_null_ids(spark):
    rows = [(1, "one text"), (1, "one text"), (None, "other text"), (None, None), (1, "")]
    got = Counter(tuple(r) for r in alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), FIRST, SECOND).select("doc_id", *ALIGNED).collect())
    assert got == Counter((d, *x) for (d, _), x in zip(rows, plain_alignment([t for _, t in rows]), strict=True))


def test_bound_alignment(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r[c] for c in ALIGNED) for r in queries.QUERIES["op13_token_alignment"](spark, sf_dir).collect()}
    assert got == dict(zip([d for d, _ in docs], plain_alignment([t for _, t in docs]), strict=True))


@pytest.mark.parametrize("runs", [0, 1, 5, 300])
def test_runs_merge_to_counts(runs):
    rng = np.random.default_rng(runs)
    merger, expected = alignment.Merger(), Counter()
    for _ in range(runs):
        pairs = np.unique(rng.integers(0, 200, 40)).astype("<i8")
        docs = rng.integers(1, 9, len(pairs)).astype("<i8")
        expected.update(dict(zip(pairs.tolist(), docs.tolist())))
        merger.add(alignment._packed(pairs, docs))
    pairs, counts = merger.finish()
    assert dict(zip(pairs.tolist(), counts.tolist())) == expected and (np.diff(pairs) > 0).all()
    best = alignment.best_of_first(pairs, counts, 4)
    for p, n, b in zip(pairs.tolist(), counts.tolist(), best.tolist()):
        assert b == (n == max(m for q, m in expected.items() if q >> 4 == p >> 4))
