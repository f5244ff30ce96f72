"""The bound corpus queries over a whole small data set."""

from __future__ import annotations

import hashlib
import zlib

import compare
import numpy as np
import plain
import public_tokenizers
import pytest

import corpus_pipeline
from tidemark import session
from tidemark.llm import ngrams, oracle, queries, warc


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    compare.assert_same(queries.QUERIES[name](spark, sf_dir), duck, oracle.ORACLE[name])


def _rows(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir).collect()


def test_substring_dedup(spark, sf_dir, docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in _rows(spark, sf_dir, "op2_substring_dedup")}
    expected = plain.removals([t for _, t in docs])
    assert got == {d: (n, cut, plain.sha(kept)) for (d, _), (n, cut, kept) in zip(docs, expected, strict=True)}


def test_archives(spark, sf_dir):
    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    first = {}
    for page, body in sorted(pages):
        first.setdefault(body, page)
    expected = {
        page: (len(body), warc.payload_digest(body), *(("response", None) if first[body] == page else ("revisit", first[body])))
        for page, body in pages
    }
    rows = _rows(spark, sf_dir, "op3_warc")
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows} == expected and len(rows) == len(pages)


def test_byte_bpe(spark, sf_dir, docs):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    digest = lambda data: hashlib.sha256(data).hexdigest()
    expected = {}
    for d, text in docs:
        ids = library.encode_ordinary(text or "")
        expected[d] = len(ids), digest(",".join(map(str, ids)).encode()), digest((text or "").encode())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in _rows(spark, sf_dir, "op9_byte_bpe")} == expected


def test_token_shards(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, expected = 0, {}
    for d, text in sorted(docs):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected[d] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in _rows(spark, sf_dir, "op4_repair_ids")} == expected


def test_toxicity_columns(spark, sf_dir, docs):
    rows = _rows(spark, sf_dir, "op5_toxicity")
    assert {r.doc_id: r.held_out for r in rows} == {d: plain.remainder(d) == 0 for d, _ in docs}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_language_model(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in _rows(spark, sf_dir, "op6_ngram_scores")}
    expected = plain.lm(docs, lambda d: plain.remainder(d) != 1, ngrams.LEAST_PAIR, ngrams.PRIOR)
    for (d, _), (n, known, total, base, score) in zip(docs, expected, strict=True):
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (plain.remainder(d) == 1, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert abs(r.score - score) <= 0.02 * n


def test_near_duplicates(spark, sf_dir, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in _rows(spark, sf_dir, "op7_ngram_jaccard")}
    assert got == plain.classes(docs, 9, 10, 3)


def test_token_counts(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in _rows(spark, sf_dir, "op8_token_counts"):
        text = dict(docs)[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)


def test_pipeline_stages(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = table.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in table.select("doc_id", "text").collect()}
        table = session.checkpointed(stage(spark, table, sf_dir))
        kept[name] = before, table
        if name != corpus_pipeline.STAGES[-1][0]:
            assert table.columns == columns
    texts = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    before, after = kept["ngram_jaccard"]
    roots = plain.classes(list(before.items()), 4, 5, 5)
    assert set(texts(after)) == {d for d, (_, root) in roots.items() if root == d}
    before, after = kept["substring_dedup"]
    cut = plain.removals(list(before.values()))
    assert texts(after) == {
        d: b" ".join(words).decode() if removed else t for (d, t), (_, removed, words) in zip(before.items(), cut, strict=True)
    }
    before, after = kept["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(texts(after)) == set(before) - {d for d, *_ in plain.contained(list(before.items()), items)}
    before, after = kept["byte_bpe"]
    assert {r.doc_id for r in after.collect()} == set(before) and all(r.n_tokens == len(r.ids) for r in after.collect())
