"""Tables for the training-data tests."""

from __future__ import annotations

import random
import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def make_texts(seed: int = 5) -> list[str | None]:
    """Null, empty, sign-only, short, repeated, very long and ordinary texts, near copies and a shared passage."""
    rng = random.Random(seed)
    vocab = [f"w{i}é" if i % 7 == 0 else f"word{i}" for i in range(900)]
    pick = lambda n: [rng.choice(vocab) for _ in range(n)]
    texts: list[str | None] = [None, "", "", "!!! ???", "one", "one", "Two  words", "Two words", "<|endoftext|> special"]
    base = pick(120)
    for _ in range(60):
        near = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            near[rng.randrange(len(near))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    passage = pick(60)
    for _ in range(40):
        own = pick(70)
        k = rng.randrange(70)
        texts.append(" ".join(own[:k] + passage + own[k:]))
    texts += [" ".join(pick(rng.randrange(3, 60))) for _ in range(60)]
    texts += ["the same text here, twice over. " * 3] * 20
    long = ". ".join(" ".join(pick(12)) for _ in range(9000))
    texts += [long, long + " tail", "a" * 300_000]
    rng.shuffle(texts)
    return texts


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with ids 0.., extra columns with names that operators use, rows in no order."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), i, "x", True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long, score string, kept boolean").repartition(5)
