"""Near-dedup, decontamination and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import words
from zonepace.llm import decontamination as D
from zonepace.llm import near_dedup as N
from zonepace.llm import substring_dedup as S
from zonepace.llm import words as W
from zonepace.llm.components import components


def _find(up, x):
    while up.get(x, x) != x:
        x = up[x]
    return x


def _join(up, a, b):
    a, b = _find(up, a), _find(up, b)
    if a != b:
        up[max(a, b)] = min(a, b)


def brute_classes(texts, threshold=0.8):
    shingles, up, seen = [], {}, {}
    for i, t in enumerate(texts):
        w = words(t)
        s = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
        shingles.append(s)
        if w:
            _join(up, i, seen.setdefault(tuple(w), i))
    # Provisional classes as the module's min-hashes place them, counted in plain dictionaries.
    text, shing, _, at = N.counted(pa.array(texts, pa.string()), 5)
    value = [W.mix(shing ^ m) for m in N._MINHASH]
    pair = {i: tuple(int(v[at[i]:at[i + 1]].min()) for v in value) for i in range(len(texts)) if at[i + 1] > at[i]}
    votes = defaultdict(Counter)
    for one, two in pair.values():
        votes[one][two] += 1
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    place = {one: max(c, key=lambda two: (c[two], signed(two))) for one, c in votes.items()}
    held = defaultdict(set)
    for i, (one, _) in pair.items():
        for s in shingles[i]:
            held[s].add(place[one])
    n = len(set(place.values()))
    idf = {s: max(1e-3, min(1, math.log(1 / max(len(c) / n, N.FLOOR)) / math.log(1 / N.FLOOR))) for s, c in held.items()}
    total = [sum(c * idf[s] for s, c in x.items()) for x in shingles]
    reps, where, both = sorted(set(seen.values())), defaultdict(list), defaultdict(float)
    for i in reps:
        for s in shingles[i]:
            where[s].append(i)
    for s, ids in where.items():
        for x in range(len(ids)):
            for y in range(x):
                both[ids[y], ids[x]] += idf[s] * min(shingles[ids[x]][s], shingles[ids[y]][s])
    for (a, b), c in both.items():
        if c >= threshold * (total[a] + total[b] - c) - 1e-9:
            _join(up, a, b)
    return [_find(up, i) for i in range(len(texts))]


def test_near_classes_against_brute_force(docs, texts):
    want = brute_classes(texts)
    size = Counter(want)
    got = {r.doc_id: (r.class_id, r.class_size, r.kept) for r in N.near_classes(docs).collect()}
    assert got == {i: (c, size[c], c == i) for i, c in enumerate(want)}
    assert max(size.values()) > 20
    left = N.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want))


def test_large_near_copy_group_keeps_its_links(spark, docs, texts, monkeypatch):
    """A third of all rows are near copies: they do not lower the weights of their own text, so plain Jaccard links them too."""
    monkeypatch.setattr(N, "FLOOR", 1 - 1e-9)  # idf 1 for every shingle
    want = brute_classes(texts)
    monkeypatch.undo()
    assert max(Counter(want).values()) > 40
    assert {r.doc_id: r.class_id for r in N.near_classes(docs).collect()} == dict(enumerate(want))
    # Two near copies of a text that has many exact copies.
    rng = random.Random(8)
    base = [f"h{i}" for i in range(100)]
    near = [" ".join([*base[:k], "new", *base[k + 1:]]) for k in (30, 60)]
    rows = [" ".join(base)] * 60 + near + [" ".join(f"o{rng.randrange(10**6)}" for _ in range(50)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert Counter(r.class_size for r in N.near_classes(df).collect()) == {62: 62, 1: 60}


def test_near_classes_edges(spark):
    kind = "doc_id long, text string"
    assert N.near_classes(spark.createDataFrame([], kind)).count() == 0
    rows = [(None, "a b c d e f"), (3, "A B c, d e f"), (3, "something else entirely, with more words"), (4, None), (5, "")]
    got = sorted((r.doc_id or -1, r.class_id, r.class_size, r.kept) for r in N.near_classes(spark.createDataFrame(rows, kind)).collect())
    assert got == [(-1, 3, 2, False), (3, 3, 1, True), (3, 3, 2, True), (4, 4, 1, True), (5, 5, 1, True)]


def test_block_links_equal_pairs():
    rng = random.Random(4)
    base = [f"b{i}" for i in range(80)]
    made = []
    for _ in range(60):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            w[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
        made.append(" ".join(w + ["z z z z z z z"] * rng.randrange(2)))
    tables = np.ones((2, 1 << N.SKETCH_BITS), np.float32)
    comp = np.arange(60) // 2
    focus = comp > 4
    up = {}
    for a, b in N.link_block(pa.array(made), comp, focus, np.ones(60, bool), tables, 5, 0.8):
        _join(up, a, b)
    want = {}
    x, y = np.nonzero(focus[:, None] & np.ones(60, bool)[None, :])
    for i, j, s in zip(x, y, N.pair_similarity(pa.array([made[i] for i in x]), pa.array([made[j] for j in y]), tables, 5)):
        if s >= 0.8 - 1e-9:
            _join(want, int(comp[i]), int(comp[j]))
    assert [_find(up, c) for c in range(30)] == [_find(want, c) for c in range(30)]


def test_icws_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    shing = rng.integers(1, 2**63, 1500).astype(np.uint64)
    weight = rng.uniform(0.2, 3, 1500)
    a, b = np.arange(0, 1000), np.arange(300, 1500)
    wa, wb = np.zeros(1500), np.zeros(1500)
    wa[a], wb[b] = weight[a], weight[b] * rng.uniform(0.8, 1.2, len(b))
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    sig = N.icws(np.concatenate([shing[a], shing[b]]), np.concatenate([wa[a], wb[b]]), np.array([0, len(a)]), 3000)
    assert abs((sig[:, 0] == sig[:, 1]).mean() - true) < 0.03


def test_components_random_graphs(spark):
    rng = random.Random(2)
    for n, m in ((40, 30), (60, 90), (30, 29)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != 29 else [(i, i + 1) for i in range(29)]
        up = {}
        for a, b in edges:
            _join(up, a, b)
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
        linked = {x for a, b in edges if a != b for x in (a, b)}
        assert got == {x: _find(up, x) for x in linked}


def brute_hits(texts, items, width=10):
    out = []
    grams = defaultdict(set)
    for k, t in items:
        w = words(t)
        size = min(width, len(w))
        for p in range(len(w) - size + 1 if w else 0):
            grams[tuple(w[p:p + size])].add(str(k) if k is not None else "")
    sizes = {len(g) for g in grams}
    for t in texts:
        w = words(t)
        hit, found = set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                if (g := grams.get(tuple(w[p:p + size]))):
                    hit |= set(range(p, p + size))
                    found |= g
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_decontamination_against_brute_force(spark, docs, texts):
    plain = [t for t in texts if t and 50 < len(t) < 5000]
    items = [(i, " ".join(words(t)[5:5 + n]).upper()) for i, (t, n) in enumerate(zip(plain, [9, 10, 11, 25, 40, 3] * 4))]
    items += [(100, "one"), (101, None), (102, "!!"), (103, "Two words"), (None, items[3][1]), (3, items[3][1]), (105, "never seen anywhere at all in these texts so no hit")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_hits(texts, items)
    for slice_bytes in (1 << 20, 600):
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in D.find_matches(docs, bench, slice_bytes=slice_bytes).collect()}
        assert got == {i: (n, h, k, h > 0) for i, (n, h, k) in enumerate(want)}
    clean = D.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, (_, h, _) in enumerate(want) if not h]
    one = D.find_matches(docs, spark.createDataFrame([(7, plain[0])], "item_id long, text string")).filter("n_hit > 0").collect()
    for r in one:  # a longest match is verbatim and cannot be extended
        w, q = words(texts[r.doc_id]), words(plain[0])
        for m in r.matches:
            assert w[m.word:m.word + m.length] == q[m.item_word:m.item_word + m.length]
            assert w[m.word + m.length:m.word + m.length + 1] != q[m.item_word + m.length:m.item_word + m.length + 1] or m.item_word + m.length == len(q)


def test_decontamination_edges(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.find_matches(docs, empty).filter("contaminated").isEmpty()
    assert D.remove_contaminated(docs, empty).count() == docs.count()
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.find_matches(docs.limit(0), bench).count() == 0
    from zonepace.llm.queries import op8_decontamination  # noqa: F401  the digest of no items
    none = D.find_matches(docs, bench).select(F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("h")).distinct().collect()
    assert [r.h for r in none] == [hashlib.sha256(b"").hexdigest()]


def brute_chunks(text: bytes):
    """Cuts by the definition, one byte at a time."""
    h, hashes = 0, []
    for b in text:
        h = (h * 2 + int(S.GEAR[b])) & 0xFFFF
        hashes.append(h)
    cuts = [0]
    for i, h in enumerate(hashes):
        before, after = hashes[max(0, i - S.REACH):i], hashes[i + 1:i + 1 + S.REACH]
        if len(before) == S.REACH and all(h < x for x in before) and all(h <= x for x in after) and i + 1 < len(text):
            cuts.append(i + 1)
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(text)]):
        out += range(a, b, S.MAX_CHUNK)
    return [(a, b) for a, b in zip(out, [*out[1:], len(text)])] if text else []


def test_chunks_by_definition(texts, monkeypatch):
    some = [t or "" for t in texts if len(t or "") < 3000]
    for block in (W.BLOCK, 100):
        monkeypatch.setattr(W, "BLOCK", block)
        data, offsets = W.buffers(pa.array(some))
        starts, owner = S.chunk_starts(data, offsets)
        lengths = np.diff(np.append(starts, offsets[-1]))
        for i, t in enumerate(some):
            mine = owner == i
            # The first cut of a text may look at bytes before its start, so compare from the second REACH on.
            got = [(int(a - offsets[i]), int(a - offsets[i] + n)) for a, n in zip(starts[mine], lengths[mine])]
            raw = t.encode()
            assert got == [] if not raw else (got[0][0] == 0 and got[-1][1] == len(raw) and all(a[1] == b[0] for a, b in zip(got, got[1:])))
            inner = {a for a, _ in got if a > 2 * (S.REACH + S.SPAN) and a < len(raw) - S.REACH}
            assert inner >= {a for a, _ in brute_chunks(raw) if 3 * (S.REACH + S.SPAN) < a < len(raw) - S.REACH and a % S.MAX_CHUNK} or len(set(raw)) < 9


def test_repeated_passages(spark):
    rng = random.Random(9)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passages = [make(51) for _ in range(30)]
    rows = [(1000 + i, make(80)) for i in range(40)]  # clean
    for i, p in enumerate(passages):
        for k in range(3):
            own = make(90).split(" ")
            at = rng.randrange(len(own))
            rows.append((10 * i + k, " ".join([*own[:at], p, *own[at:]])))
    rows += [(2000, None), (2001, ""), (2002, rows[0][1]), (2003, "Licensed under the MIT License. " + make(30)), (2004, "Licensed under the MIT License. " + make(30))]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, digest int").repartition(4)
    got = S.repeated_passages(df).collect()
    text = dict(rows)
    found = {r.doc_id for r in got}
    planted = {10 * i + k for i in range(30) for k in range(3)}
    assert planted <= found and found <= planted | {1000, 2002}
    for r in got:
        piece = text[r.doc_id].encode()[r.start:r.start + r.n_bytes]
        assert len(piece) == r.n_bytes and piece in text[r.first_doc_id].encode()
        assert r.removed == (r.removed_bytes > 0) == (r.doc_id != r.first_doc_id)
    assert S.repeated_passages(df.limit(0)).count() == 0


def test_passages_of_51_short_words_are_all_found(spark):
    """Passages of 51 words and 150 to 250 bytes, whose shared chunks often are too short a run."""
    rng = random.Random(3)
    make = lambda n, most: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, most))) for _ in range(n))
    rows, at = [], {}
    for i in range(60):
        p = make(51, 4 + i % 4)
        for k in range(2):
            before = make(60, 9) + " "
            rows.append((2 * i + k, before + p + " " + make(60, 9)))
            at[2 * i + k] = (len(before), len(before) + len(p))
    rows += [(1000 + i, make(30, 9) + " " + " ".join(f"same{j}" for j in range(9)) + " " + make(30, 9)) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = S.repeated_passages(df).collect()
    assert {r.doc_id for r in got} == set(at)
    text = dict(rows)
    for r in got:
        a, b = at[r.doc_id]
        assert text[r.doc_id][r.start:r.start + r.n_bytes] in text[r.first_doc_id]
        assert r.n_chunks or (a, b) == (r.start, r.start + r.n_bytes)
        assert r.removed == (r.removed_bytes > 0) == (r.doc_id != r.first_doc_id)


def test_removed_passages_are_left_once(spark):
    """Passages of several owners in one run: what goes is exactly what an earlier document keeps."""
    rng = random.Random(21)
    for draw in range(3):
        width = [1, 5, 9][draw]
        word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüß") for _ in range(width))  # noqa: E731, B023
        passage = [" ".join(word() for _ in range(n)) for n in (53, 53, 90, 60)]
        x, y, z, u = passage
        own = lambda n=8: " ".join(f"{word()}{rng.randrange(10**6)}" for _ in range(n))
        texts = {1: f"{x}", 5: f"{y} {x}", 9: f"{y} {x}", 12: f"{own()} {z} {own()}", 13: f"{z} {x} {own()}", 14: f"{own()} {u} {y}", 15: f"{u} {own()}"}
        df = spark.createDataFrame([(i, t, "k") for i, t in texts.items()], "doc_id long, text string, key string")
        found = S.repeated_passages(df)
        rows = found.collect()
        assert all(r.removed == (r.removed_bytes > 0) and r.start + r.n_bytes <= len(texts[r.doc_id].encode()) for r in rows)
        for r in rows:  # a removed stretch stands in the document it repeats
            piece = texts[r.doc_id].encode()[r.start:r.start + r.n_bytes]
            assert not r.removed or piece in texts[r.first_doc_id].encode()
        left = {r.doc_id: r.text for r in S.without_passages(df, found).collect()}
        assert left.keys() == texts.keys()
        middle = lambda p: " ".join(p.split()[20:33])
        for p in passage:
            assert [i for i, t in left.items() if middle(p) in t] == [min(i for i, t in texts.items() if p in t)]
