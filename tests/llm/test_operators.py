"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing names and no rows."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard, ngrams, quality, repair, ship, substring, token_counts, toxicity, warc
from tidemark.llm import text as tx
from tidemark.llm.pieces import Pieces

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_quality_measures(odd, none, odd_rows):
    got = {r.doc_id: tuple(r[m] for m in quality.MEASURES) for r in quality.ledger(odd).collect()}
    assert got == {d: plain.quality(t) for d, t in odd_rows}
    assert quality.ledger(none).count() == 0


def test_policies_and_ablations_agree_with_the_ledger(odd):
    rows = quality.apply_policies(quality.ledger(odd)).collect()
    words = [r.failed for r in rows]
    for r in rows:
        for version, names in quality.POLICIES.items():
            assert r[f"kept_{version}"] == (r.failed & quality.mask(names) == 0)
    for r in quality.ablations(quality.ledger(odd)).collect():
        whole = quality.mask(quality.POLICIES[r.policy])
        own = quality.bit(r.rule)
        assert r.documents == len(words)
        assert r.kept == sum(w & whole == 0 for w in words)
        assert r.kept_without == sum(w & whole & ~own == 0 for w in words)
        assert r.sole_reason == sum(w & whole == own for w in words)


def test_ablations_of_no_rows(none):
    assert {(r.documents, r.kept) for r in quality.ablations(quality.ledger(none)).collect()} == {(0, 0)}


def test_substring_removal(odd, none, odd_rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.removals(odd).collect()}
    expected = plain.removals([t for _, t in odd_rows])
    assert got == {d: (n, cut, plain.sha(kept)) for (d, _), (n, cut, kept) in zip(odd_rows, expected, strict=True)}
    assert substring.removals(none).count() == 0


def test_substring_removal_in_small_shards(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", 500)
    monkeypatch.setattr(substring, "BLOCK_WORDS", 2_000)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.removals(odd, span=10).collect()}
    expected = plain.removals([t for _, t in odd_rows], 10)
    assert got == {d: (n, cut, plain.sha(kept)) for (d, _), (n, cut, kept) in zip(odd_rows, expected, strict=True)}


def test_cut_texts_keep_columns_and_clean_texts(odd, odd_rows):
    cut = substring.without_repeats(odd)
    assert cut.columns == odd.columns
    got = {r.doc_id: r.text for r in cut.select("doc_id", "text").collect()}
    for (d, text), (_, removed, kept) in zip(odd_rows, plain.removals([t for _, t in odd_rows]), strict=True):
        assert got[d] == (b" ".join(kept).decode() if removed else text)


def test_automaton_finds_all_long_matches():
    rng = np.random.default_rng(3)
    passages = [[b"%d" % x for x in rng.integers(0, 3, n)] for n in (40, 7, 25)]
    asked = [b"%d" % x for x in rng.integers(0, 3, 200)]
    known = {tuple(p[i : i + 5]) for p in passages for i in range(len(p) - 4)}
    covered = {i + k for i in range(len(asked) - 4) if tuple(asked[i : i + 5]) in known for k in range(5)}
    spans = substring.Automaton(passages).matches(asked, 5)
    assert {i for a, b in spans for i in range(a, b)} == covered


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, key string, uri string, first string")


def test_archives_round_trip(spark, odd, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4_000)
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 4)
    bodies = [None, "", "<p>é</p>", "x" * 3000, "<p>é</p>", "", "unique"]
    urls = [None, "", "http://a.example/1", "https://user@b.a.example:8080/x?y=1", "no scheme", "http://a.example/1", "http://[bad", "h://\n\x1f%/"]
    rows = [(i, urls[i % len(urls)], bodies[i % len(bodies)], "k", "u", "f") for i in range(60)]
    got = {r.page_id: r for r in warc.archive_and_read(_pages(spark, rows).repartition(3)).collect()}
    first: dict[str, int] = {}
    for i, _, html, *_ in rows:
        first.setdefault(html or "", i)
    assert set(got) == set(range(60))
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        own = first[html or ""]
        assert got[i].payload_bytes == len(body)
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if own == i else ("revisit", own))
    assert warc.archive_and_read(_pages(spark, [])).count() == 0


def test_urls_cannot_break_headers_and_null_ids_have_rows(spark, odd):
    urls = ["http://a.org/x\r\nFoo", "http://a.org/x\r\n\r\nbody", "http://a.org/\nWARC-Type: revisit", "\u2028", "http://a.org/x y%0A"]
    rows = [(i, u, f"body {i}", "", "", "") for i, u in enumerate(urls)]
    rows += [(None, "http://a.org/x", "body 2", "", "", ""), (None, "http://n.org/", "alone", "", "", ""), (None, None, "alone", "", "", "")]
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_and_read(_pages(spark, rows)).collect()]
    expected = [(i, 6, "response", None) for i in range(5)] + [(None, 6, "revisit", 2)] + 2 * [(None, 5, "response", None)]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    headers, body = warc.parse(warc.record(7, urls[2], b"x", "D", None))
    assert (headers["WARC-Target-URI"], headers["WARC-Type"], body) == ("http://a.org/%0AWARC-Type: revisit", "response", b"x")


def test_small_payloads_are_not_revisited(spark, odd):
    rows = [(i, "u", "ab", "", "", "") for i in range(3)] + [(i, "u", "abcdef", "", "", "") for i in range(3, 6)]
    got = {r.page_id: r.record_type for r in warc.archive_and_read(_pages(spark, rows), least_revisit=3).collect()}
    assert [got[i] for i in range(6)] == ["response"] * 4 + ["revisit"] * 2


def test_lookup_of_unknown_pages_gives_no_row(spark, odd):
    from tidemark.llm import ship

    pages = _pages(spark, [(i, f"http://h{i % 3}.example/{i}", "b", "", "", "") for i in range(20)])
    folder = ship.folder(spark, "warc-test")
    index = warc.build_index(warc.write(pages, folder), folder)
    asked = spark.createDataFrame([("http://h1.example/1", 1), ("http://h1.example/1", 2), ("http://zz/", 99), ("", -1)], "url string, page_id long")
    assert [r.page_id for r in warc.lookup(spark, index, asked).collect()] == [1]


def test_host_is_reversed():
    assert warc.url_key("https://www.Example.com/a?b=1") == "com,example,www)/a?b=1"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_shards(odd, none, odd_rows, library, monkeypatch):
    monkeypatch.setattr(repair, "SHARD_IDS", 2_000)
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in repair.encode_and_read(odd, path, 2).collect()}
    at, expected = 0, {}
    for d, text in sorted(odd_rows):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected[d] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == expected
    assert repair.encode_and_read(none, path, 2).count() == 0


@pytest.mark.parametrize("ids", [[], [5], [7] * 1000, list(range(300)) * 20, [1, 1, 2, 1, 1, 1, 2] * 100])
def test_grammar_round_trip_and_random_access(ids):
    ids = np.array(ids, np.int32)
    counts = np.array([len(ids) // 3, len(ids) - len(ids) // 3])
    shard = repair.Shard(repair.pack(ids, counts, [1, 2], 1000))
    assert shard.ids().tolist() == ids.tolist()
    assert shard.document(1).tolist() == ids[counts[0] :].tolist()
    for a in range(0, len(ids), 37):
        assert shard.read(a, a + 11).tolist() == ids[a : a + 11].tolist()


def test_grammar_shortens_repeats():
    ids = np.tile(np.arange(50, dtype=np.int32), 400)
    symbols, rules = repair.compress(ids, 100)
    assert len(symbols) < len(ids) / 8 and len(rules)


def test_token_counts(odd, none, odd_rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(odd, path).collect()}
    assert got == {
        d: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in odd_rows
    }
    assert token_counts.count_tokens(none, path).count() == 0


def test_token_counts_of_a_piece_model(odd, odd_rows):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(odd, path).collect()}
    assert got == {d: len(model.encode(t or "", num_threads=1)) for d, t in odd_rows}


def test_frequent_pieces_come_from_the_whole_corpus(spark, monkeypatch):
    """The table holds the frequent pre-tokens of every part, and no text is shuffled for it."""
    ship.prepare(spark)
    rows = [(i, " ".join(f"part{i % 8}{chr(97 + i % 8)}" for _ in range(50)) + f" rare{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    monkeypatch.setattr(token_counts, "HELD", 60)
    monkeypatch.setattr(token_counts, "SENT", 20)
    tokenizer = token_counts.Tokenizer.read(public_tokenizers.path("word_bpe_49k.json"))
    table = token_counts.frequent_lengths(docs, tokenizer, "text")
    (_, _, t), = tx.texts(pa.array([" ".join(f"part {chr(97 + i)}" for i in range(8))]))
    assert (table.find(token_counts.WordPieces(t).hashes()) == 1).all()
    plan = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_counts_with_a_crowded_table(monkeypatch):
    tokenizer = token_counts.Tokenizer.read(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(token_counts, "CACHE_SLOTS", 4)
    counter = token_counts.Counter(tokenizer, token_counts.Lengths(8))
    texts = [f"some words {i} and Others' {i * i} naïveté" for i in range(200)]
    for _ in range(2):
        got = np.concatenate([counter.of(t) for _, _, t in tx.texts(pa.array(texts))]).tolist()
        assert got == counter.count(texts)


def test_byte_bpe(odd, none, odd_rows):
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    coded = bpe.encode(odd, RANKS)
    assert {r.doc_id: r.ids for r in coded.collect()} == {d: library.encode_ordinary(t or "") for d, t in odd_rows}
    decoded = {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, RANKS).collect()}
    assert decoded == {d: (t or "").encode() for d, t in odd_rows}
    assert {r.doc_id: bytes(r.decoded) for r in bpe.encode(odd, RANKS, verify=True).collect()} == decoded
    assert bpe.encode(none, RANKS, verify=True).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 5000])
def test_perfect_hash_is_minimal(n):
    keys = tx.mix(np.arange(n, dtype=np.uint64))
    table = bpe.PerfectHash(keys)
    assert sorted(table.find(keys).tolist()) == list(range(n))
    assert (table.find(tx.mix(np.arange(n, 2 * n + 10, dtype=np.uint64))) == -1).all()


def test_pieces_follow_the_pattern():
    import regex

    texts = ["it's  we'll'd ''s 'S x's's", "\n\n a  b\t\tc 12ab ½! ...?", "", " ", "a \u3000b"]
    (_, _, t), = tx.texts(pa.array(texts))
    pieces = Pieces(t)
    got = [[pieces.piece(i).decode() for i in range(a, b)] for a, b in zip(pieces.first, pieces.first[1:])]
    assert got == [regex.findall(public_tokenizers.PATTERN, x) for x in texts]


def test_contained_items(spark, odd, none, odd_rows):
    long = dict(odd_rows)[19].split()
    items = [
        (0, " ".join(long[100:140])), (1, " ".join([*long[100:104], "zz", *long[105:140]])), (2, "One"), (3, "TWO  words"),
        (4, None), (5, ""), (6, " ".join([*long[0:20], "y", "z", "q", *long[200:215]])), (None, "one"), (7, "a" * 5000), (0, " ".join(long[100:140])),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in decontaminate.contained(odd, table).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain.contained(odd_rows, items)
    assert decontaminate.contained(none, table).count() == 0
    assert decontaminate.contained(odd, table.limit(0)).count() == 0
    kept = decontaminate.without_contaminated(odd, table)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, _ in odd_rows} - {r[0] for r in got}


def test_containment_runs_no_python(odd, spark):
    table = spark.createDataFrame([(0, "a b c d e f")], "item_id long, text string")
    plan = decontaminate.contained(odd, table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_near_duplicates(odd, odd_rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(odd).collect()}
    assert got == plain.classes(odd_rows, 9, 10, 3)
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, (_, c) in got.items() if c == d}


def test_language_model(odd, none, odd_rows, monkeypatch):
    monkeypatch.setattr(ngrams, "SHARD_TOKENS", 5_000)
    monkeypatch.setattr(ngrams, "HELD_PAIRS", 4_000)
    model = ngrams.train(odd, F.col("doc_id") % 5 != 1)
    got = {r.doc_id: tuple(r)[1:] for r in ngrams.score(odd, model).collect()}
    for (d, _), (n, known, total, base, score) in zip(odd_rows, plain.lm(odd_rows, lambda d: d % 5 != 1, 1), strict=True):
        assert got[d][:3] == (n, known, total)
        assert got[d][3] == pytest.approx(base, rel=1e-9)
        assert abs(got[d][4] - score) <= 0.02 * n
    empty = ngrams.train(none, F.lit(True))
    assert {(r.n_known, r.score) for r in ngrams.score(odd, empty).collect()} == {
        (0, r.base_score) for r in ngrams.score(odd, empty).collect()
    } or all(r.score == r.base_score and r.n_known == 0 for r in ngrams.score(odd, empty).collect())
    assert ngrams.score(none, model).count() == 0


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (5, 10), (1000, 1_100), (1000, 10**12), (64, 10**15)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, top, n)).astype(np.uint64)
    coded = ngrams.EliasFano(np.frombuffer(ngrams.EliasFano.pack(values), np.uint8))
    asked = np.unique(np.concatenate([values, values + np.uint64(1), rng.integers(0, 2 * top, 200).astype(np.uint64)]))
    place = {int(v): i for i, v in enumerate(values.tolist())}
    assert coded.find(asked).tolist() == [place.get(int(v), -1) for v in asked.tolist()]


def _toxic_corpus(n, seed):
    rng = np.random.default_rng(seed)
    mild = [f"{a}{b}" for a in ("the", "on", "re", "at", "in") for b in ("er", "ing", "ly", "th", "nd", "st")]
    bad = ["horribleword", "nastything", "vileterm"]
    texts, labels = [], []
    for _ in range(n):
        w = [mild[i] for i in rng.integers(0, len(mild), rng.integers(20, 120))]
        toxic = rng.random() < 0.3
        if toxic:
            for k in rng.integers(0, len(w), 3):
                w[k] = bad[rng.integers(0, len(bad))]
        texts.append(" ".join(w))
        labels.append(int(toxic))
    return texts, np.array(labels, bool)


def test_toxicity_on_held_out_texts_and_misspellings():
    texts, labels = _toxic_corpus(600, 1)
    counted = [f for _, _, t in tx.texts(pa.array(texts), lower=True) for f in toxicity.features(t)]
    border = np.cumsum([0, *(len(b) for b, _ in counted)])
    model = toxicity.train(*(np.concatenate(c) for c in zip(*counted)), border, np.array(labels, bool), share=0.3)

    def scores(texts):
        return np.concatenate([model.scores(t) for _, _, t in tx.texts(pa.array(texts), lower=True)])

    texts, labels = _toxic_corpus(300, 2)
    assert ((scores(texts) >= 0.5) == labels).mean() > 0.97
    mild = "theer oning rely " * 10
    spelt = scores([mild + "horrible-word nastythinng vileterms " * 2, mild])
    assert spelt[0] > 0.5 > spelt[1]


def test_toxicity_of_odd_rows(spark, odd, none, odd_rows):
    labels = spark.createDataFrame([(1, 0, 9), (3, 1, 9), (5, None, 9), (12, 1, 9), (13, 0, 9), (None, 1, 9)], "doc_id long, toxic int, text int")
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert {r.doc_id for r in rows} == {d for d, _ in odd_rows} and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, model).count() == 0
    kept = toxicity.without_toxic(odd, model)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in rows if r.score < 0.5}
    silent = toxicity.fit(odd, labels.limit(0))
    assert max(r.score for r in toxicity.score(odd, silent).collect()) < 0.5


def test_toxicity_sample_is_bounded_by_rows_not_by_texts(spark, monkeypatch):
    """A thousand rows of one id, labels given twice, few toxic labels, and one very long text."""
    ship.prepare(spark)
    rng = np.random.default_rng(5)
    prose = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 400, n))
    rows = [(0, "much of one id")] * 1000 + [(i, prose(60) + (" vile scum" if i < 5 else "")) for i in range(1, 60)]
    rows.append((60, " ".join(f"x{i}" for i in range(200_000))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = [(i, int(0 < i < 5)) for i in range(61)]
    labelled = spark.createDataFrame(labels * 2, "doc_id long, toxic int")
    buckets, weights, border, toxic, share = toxicity.sample(docs, labelled, F.lit(True), "doc_id", "text", "toxic")
    assert len(toxic) == 61 and toxic.sum() == 4 and share == 4 / 61
    assert np.diff(border).max() == toxicity.FEATURES and len(buckets) == len(weights) == border[-1]
    _, _, whole = next(tx.texts(pa.array([rows[-1][1]]), lower=True))
    ((names, own),) = toxicity.features(whole)
    back = toxicity._unpacked(toxicity._packed(names, own), len(names))
    assert (back[0] == names).all() and np.allclose(back[1], own, rtol=1e-3)
    model = toxicity.train(buckets, weights, border, toxic, 0.5)
    said = [next(tx.texts(pa.array([t]), lower=True))[2] for t in (prose(60) + " vile scum", prose(60))]
    assert model.logits(said[0])[0] > model.logits(said[1])[0] + 0.1
    monkeypatch.setattr(toxicity, "SAMPLE_NEGATIVE", 10)
    assert len(toxicity.sample(docs, labelled, F.lit(True), "doc_id", "text", "toxic")[3]) == 14
