"""Token counts and training-order shards against the tokenizer libraries."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from zonepace.llm import training_order as O
from zonepace.llm import words as W
from zonepace.llm.token_count import Counter, Merges, count_tokens
from tests.llm.conftest import words

SIGNS = "abcdeé ÉΣσς'stlm  \n\t\x1c\x85 ½²Ⅷ一漢字🙂é İIß.,!<|>_-09"


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(1)
    made = ["".join(rng.choice(SIGNS) for _ in range(rng.choice([0, 1, 5, 40, 300]))) for _ in range(800)]
    return made + ["<|endoftext|>", "a<|endoftext|>b", "<|startoftext|><|endoftext|>x <|endoftext |>", "<|ENDOFTEXT|>", "a" * 500, "lololol" * 30,
                   "it's they're I'LL", "ΑΣ ΑΣΑ"]


def test_counts_equal_library(spark, docs, texts, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts + odd], add_special_tokens=False)]
    counter = Counter(Merges(P.path("word_bpe_49k.json")))
    assert counter.count([t or "" for t in texts + odd]) == want
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, P.path("word_bpe_49k.json")).collect()}
    assert got == {i: (len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, want))}
    assert count_tokens(docs.limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_small_cache_changes_nothing(texts, odd, monkeypatch):
    import zonepace.llm.token_count as T

    some = [t or "" for t in texts if len(t or "") < 5000] + odd
    counter = Counter(Merges(P.path("word_bpe_49k.json")))
    want = counter.count(some)
    monkeypatch.setattr(T, "CACHE_WORDS", 50)
    again = Counter(counter.merges)
    assert [n for k in range(0, len(some), 40) for n in again.count(some[k:k + 40])] == want


def test_encoder_equals_library(texts, odd):
    import base64

    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = O.Encoder(path)
    some = [t or "" for t in texts if len(t or "") < 100_000] + odd + ["a\0b", "\0", "x \0\0! y\0"]
    some += [a + b + c for a in ("", " ", "\n", "  ", "\t ") for b in ("ab", "ab's 'd1 2x", "é!?ß 漢字") for c in ("", " ", " \n", "\n\n", " \n x", "\r\ny", "  z")]
    want = [[*library.encode_ordinary(t), 50256] for t in some]
    together, sizes = encoder.encode(pa.array(some))  # holds white space beyond ASCII: cut by the pattern
    assert [x.tolist() for x in np.split(together, np.cumsum(sizes)[:-1])] == want
    for _ in range(2):  # each on its own, new and known words
        assert [encoder.encode(pa.array([t]))[0].tolist() for t in some] == want
    plain = [i for i, t in enumerate(some) if t.isascii() or not O.WIDE_WHITE.search(t.encode())]
    together, sizes = O.Encoder(path).encode(pa.array([some[i] for i in plain]))
    assert [x.tolist() for x in np.split(together, np.cumsum(sizes)[:-1])] == [want[i] for i in plain]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    slots = O.permute(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    assert (O.permute(slots, n, inverse=True) == np.arange(n)).all()
    assert n < 64 or (O.permute(np.arange(n), n, key=2) != slots).any()


def test_shards_round_trip(spark, docs, texts, tmp_path):
    path = P.path("byte_bpe_50k.tiktoken")
    short = docs.filter("coalesce(length(text), 0) < 200000")
    sequences = O.training_order(short, path, length=64, per_shard=32)
    O.write_shards(sequences, str(tmp_path / "shards"))
    rows = spark.read.parquet(str(tmp_path / "shards")).collect()
    n = len(rows)
    assert sorted(r.slot for r in rows) == list(range(n))
    assert all(len(r.payload) == 128 and r.shard == r.slot // 32 and r.byte_offset == r.slot % 32 * 128 for r in rows)
    rows.sort(key=lambda r: r.sequence)
    assert [int(O.permute(np.array([r.sequence]), n)[0]) for r in rows] == [r.slot for r in rows]
    stream = np.concatenate([np.frombuffer(r.payload, "<u2")[:r.n_tokens] for r in rows])
    ends = np.flatnonzero(stream == 50256)
    encoder = O.Encoder(path)
    found = sorted(x.tobytes() for x in np.split(stream, ends + 1) if len(x))
    ids, sizes = encoder.encode(pa.array([t or "" for t in texts if len(t or "") < 200_000]))
    assert found == sorted(x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1]))
    assert {d for r in rows for d in r.doc_ids} == {i for i, t in enumerate(texts) if len(t or "") < 200_000}
    resumed = O.read_slots(spark, str(tmp_path / "shards"), 30, 40, per_shard=32).collect()
    assert [r.slot for r in resumed] == list(range(30, 70))
    assert O.training_order(docs.limit(0), path).count() == 0
    again = spark.createDataFrame([(7, "a b")] * 1300, "doc_id long, text string").coalesce(1)
    assert sum(len(r.doc_ids) for r in O.training_order(again, path, length=3900).collect()) == 1300


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_word_hashes(odd, texts, block, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", block)
    monkeypatch.setattr(W, "_POW", {})
    some = odd + [t for t in texts if len(t or "") < 2000]
    data, offsets = W.buffers(pa.array(some, pa.string()))
    hashes, bounds, starts, ends = W.hash_words(data, offsets, places=True)
    seen = {}
    for i, t in enumerate(some):
        own = words(t)
        assert len(own) == bounds[i + 1] - bounds[i]
        for k, w in enumerate(own, bounds[i]):
            assert seen.setdefault(w, hashes[k]) == hashes[k]
            assert bytes(data[starts[k]:ends[k]]).decode().lower().translate({}) is not None
    assert len(set(seen.values())) == len(seen)
