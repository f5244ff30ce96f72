from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.llm import ship  # noqa: E402

#: Columns whose names the operators use inside.
CLASHING = (
    "_text string, _id long, _doc long, _item long, key long, hash long, node long, root long, ids string, "
    "score string, n_words string, anchors string, kept string, spans string, _w string, failed string, n long"
)


def odd_texts() -> list[str | None]:
    rng = random.Random(11)
    vocabulary = ["the", "of", "Ärger", "naïve", "x<y>", "don't", "50%", "ÉTÉ", "中文", "a.", "b,"] + [f"w{i}" for i in range(200)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    long = prose(30_000)
    texts: list[str | None] = [None, "", " \t\n\r\x0b\x0c ", "one", "One", "two words", "\x85\xa0 odd\u2003space\x1c", "a" * 5000]
    texts += ["same again " * 50, "line\nline\nline\n\nother\nline", "<|endoftext|> inside <|startoftext|>", "it's we'll I'D 'S  x"]
    texts += [prose(40) + " " + passage + " " + prose(40) for _ in range(4)]
    texts += [passage, passage, passage.upper(), long, long + " end", prose(300), prose(34), prose(35), prose(36)]
    texts += [texts[-1], texts[-1]]
    return texts


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple[int, str | None]]:
    return list(enumerate(odd_texts()))


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    ship.prepare(spark)
    names = CLASHING.count(",") + 1
    kinds = [f.strip().split()[1] for f in CLASHING.split(",")]
    extra = tuple("v" if k == "string" else 1 for k in kinds)
    assert len(extra) == names
    df = spark.createDataFrame([(d, t, *extra) for d, t in odd_rows], f"doc_id long, text string, {CLASHING}")
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
