"""What the corpus queries must not leave out."""

from __future__ import annotations

import random
from collections import Counter

import plain
import pytest

import corpus_pipeline
from tidemark import session
from tidemark.llm import jaccard, ngrams, queries, ship, substring, warc


def _tables(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pairs_seen_once_count_in_scores(spark, tmp_path):
    """A context with one frequent follower and many that follow once, and one with these alone."""
    texts = [f"often once{i}" for i in range(90)] + ["often again"] * 10 + [f"rare then{i}" for i in range(40)]
    texts += ["often again", "often once3", "rare then5", "rare again", "often never", None]
    rows = list(enumerate(texts))
    sf_dir = _tables(spark, tmp_path, documents=(rows, "doc_id long, text string"))
    got = {r.doc_id: r.score for r in queries.QUERIES["op6_ngram_scores"](spark, sf_dir).collect()}
    learn = lambda d: plain.remainder(d) != 1
    whole = [r[4] for r in plain.lm(rows, learn, 1, ngrams.PRIOR)]
    pruned = [r[4] for r in plain.lm(rows, learn, 2, ngrams.PRIOR)]
    assert max(abs(a - b) for a, b in zip(whole, pruned, strict=True)) > 0.3
    for (d, _), score in zip(rows, whole, strict=True):
        assert got[d] == pytest.approx(score, abs=0.02 * len(plain.words(texts[d])) + 0.02)


def _prose(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_pipeline_keeps_one_of_repeated_rows(spark, tmp_path):
    """Rows listed twice, null ids, and ids of two texts, through both stages that remove repeats."""
    passage = _prose(99, 50)
    clean, none, near = _prose(1, 60), _prose(2, 60), _prose(3, 100)
    first, second = (_prose(4, 60) + " " + passage), _prose(5, 60)
    other = _prose(6, 60) + " " + passage
    rows = [(1, clean), (1, clean), (None, none), (None, none), (None, near), (None, near + " end"), (7, near)]
    rows += [(4, first), (4, second), (5, other), (6, None), (6, ""), (6, ""), (None, "")]
    rows += [(8, second), (None, clean), (None, passage + " " + _prose(7, 60))]
    sf_dir = _tables(spark, tmp_path, documents=(rows, "doc_id long, text string"))
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = session.checkpointed(stages["ngram_jaccard"](spark, docs, sf_dir))
    expected = [(1, clean), (None, none), (7, near), (4, first), (4, second), (5, other), (6, None), (6, ""), (6, ""), (None, "")]
    expected += [rows[-1]]
    assert Counter(tuple(r) for r in one.collect()) == Counter(expected)
    cut = stages["substring_dedup"](spark, one, sf_dir)
    texts = [
        b" ".join(words).decode() if removed else t
        for (_, t), (_, removed, words) in zip(expected, plain.removals([t for _, t in expected]), strict=True)
    ]
    assert texts[3] != first and texts[4] == second
    assert Counter(tuple(r) for r in cut.collect()) == Counter((d, t) for (d, _), t in zip(expected, texts, strict=True))


def test_null_ids_alone_are_reduced_too(spark):
    """A class whose rows all have a null id, near copies among them; text ids as well."""
    ship.prepare(spark)
    near = _prose(3, 100)
    docs = spark.createDataFrame([(None, near), (None, near), (None, near + " end"), (None, "a b c")], "doc_id string, text string")
    assert {r.text for r in jaccard.one_of_each(docs).collect()} & {"a b c"} and jaccard.one_of_each(docs).count() == 2
    kept = substring.without_repeats(spark.createDataFrame([(None, near + " x"), (None, "y " + near)], docs.schema))
    assert sorted(r.text for r in kept.collect()) == ["x", "y"]


def test_archives_of_repeated_page_ids(spark, tmp_path, monkeypatch):
    """One id with two payloads, one of them another page's; a revisit listed twice; repeats over blocks."""
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 2)
    rows = [(1, "a.org/x", "one"), (5, "a.org/y", "one"), (5, "a.org/y", "other"), (7, "b.org", "one"), (7, "b.org", "one")]
    rows += [(9, "c.org", f"page {i}") for i in range(7)] + [(10, "c.org", "last"), (1, "a.org/x", "one")]
    sf_dir = _tables(spark, tmp_path, pages=(rows, "page_id long, url string, html string"))
    got = Counter((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in queries.QUERIES["op3_warc"](spark, sf_dir).collect())
    assert got == Counter(
        (d, warc.payload_digest(html.encode()), *(("revisit", 1) if html == "one" and d != 1 else ("response", None))) for d, _, html in rows
    )
