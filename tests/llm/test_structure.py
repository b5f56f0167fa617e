"""Conversation repair, fill-in-middle and quality rules against plain-Python twins, with hot, long, null and empty input."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tests.conftest import SF_SMALL
from zonepace.llm import conversation_repair as C
from zonepace.llm import fill_in_middle as M
from zonepace.llm import quality_rules as Q

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- op11

def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def _sorted(rows):
    tie = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r)))


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = SPACE.sub("", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _enumerated(rows, faults, most_inserts):
    """(cost, audit, repaired) by trying every edit of every row and up to ``most_inserts`` insertions at every place."""
    options = []
    for (_, role, text), fault in zip(rows, faults):
        late = 5 if fault == "truncated" else 0
        own = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            own += [(late, "K", (role, text)), (1 + late, "R", ("user", text)), (1 + late, "R", ("assistant", text))]
        options.append(own)
    inserts = [seq for n in range(most_inserts + 1) for seq in itertools.product(["user", "assistant"], repeat=n)]
    best = None
    for edits in itertools.product(*options):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            if sum(map(len, gaps)) > most_inserts:
                continue
            said, audit, cost = [], "", 0
            for k in range(len(rows) + 1):
                for role in gaps[k]:
                    said, audit, cost = [*said, (role, "")], audit + "I", cost + 5
                if k < len(rows):
                    price, letter, turn = edits[k]
                    audit, cost = audit + letter, cost + price
                    said = said + [turn] if turn else said
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in said)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, "\n".join(f"{r}:{t}" for r, t in said)
    return best


def _walked(rows, faults):
    """The same by one step a row over the automaton's states (for long conversations)."""
    spoken = {"0": "u", "s": "u", "u": "a", "a": "u"}

    def closed(v):
        for q in ("0", "s", "a", "u", "0", "s", "a"):
            if q in v:
                cost, audit, said = v[q]
                new = cost + 5, audit + "I", said + (({"u": "user", "a": "assistant"}[spoken[q]], ""),)
                v[spoken[q]] = min(v.get(spoken[q], new), new)
        return v

    v = closed({"0": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        new: dict = {}
        for q, (cost, audit, said) in v.items():
            steps = [(q, cost + 2, audit + "D", said)]
            if fault not in ("blank", "duplicate"):
                late = 5 if fault == "truncated" else 0
                steps.append((spoken[q], cost + 1 + late, audit + "R", said + (({"u": "user", "a": "assistant"}[spoken[q]], text),)))
                if role[:1] in ("", spoken[q]) or (q == "0" and role[:1] == "s"):
                    steps.append((role[:1] or q, cost + late, audit + "K", said + ((role, text),)))
            for to, *rest in steps:
                new[to] = min(new.get(to, tuple(rest)), tuple(rest))
        v = closed(new)
    cost, audit, said = min(v[q] for q in ("0", "a") if q in v)
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in said)


def _report(conv, rows, solve):
    rows = _sorted(rows)
    faults = _faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, body = solve(rows, faults) if rows else (0, "", "")
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, _sha(body))


def _conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, tie string, kind int").repartition(3)


def _grouped(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def test_repair_against_all_edit_sequences(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 4)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a b.", "c d", "e!", " \t", ""])))
    got = sorted(map(tuple, C.repair_report(_conversations(spark, rows)).collect()))
    want = sorted(_report(c, [(t, r, x) for _, t, r, x in own], lambda a, b: _enumerated(a, b, 2)) for c, own in _grouped(rows).items())
    assert got == want


def test_damaged_conversations_against_walk(spark):
    """Nulls in every column, ties, repeats, a conversation with a third of all rows, one that loses all rows."""
    rng = random.Random(4)
    text = lambda: rng.choice([None, "", "  ", "yes.", "no?", "cut off", "Grüße\x0b!", "tail. \n"])
    role = lambda t: rng.choice([["user", "assistant"][t % 2]] * 8 + ["system", "tool", None])
    rows = [(c, t, "system" if t == 0 and (c or 0) % 4 == 0 else role(t), text()) for c in [*range(90), None] for t in range(rng.randrange(1, 9))]
    rows += [(1000, t, ["user", "assistant"][t % 2], f"turn {t}." if t % 9 else text()) for t in range(700)]
    rows += [(1001, None, role(1), text()) for _ in range(40)] + [(1002, 5, role(1), text()) for _ in range(40)]
    rows += [r for r in rows if r[0] == 7] * 3
    gone = next(t for t in range(10_000) if zlib.crc32(f"2000:{t}".encode()) % 20 == 0)
    rows.append((2000, gone, "user", "x."))
    source = _conversations(spark, rows)
    got = {r[0]: tuple(r) for r in C.repair_report(source, damage=True).collect()}
    want = {c: _report(c, _damage(own), _walked) for c, own in _grouped(rows).items()}
    assert got == want and got[2000] == (2000, 0, 0, 0, 0, 0, 0, "", _sha(""))
    said: dict = {}
    for r in C.repaired_rows(source, damage=True).collect():
        said.setdefault(r.conv_id, []).append((r.seq, f"{r.role}:{r.text}"))
    assert all(_sha("\n".join(x for _, x in sorted(said.get(c, [])))) == got[c][-1] for c in got)


def test_repair_of_empty_table_and_long_text(spark):
    assert C.repair_report(_conversations(spark, [(1, 0, "user", "x")]).limit(0), damage=True).count() == 0
    long = "word " * 400_000 + "end."
    got = C.repair_report(_conversations(spark, [(1, 0, "user", long), (1, 1, "assistant", "ok.")])).first()
    assert (got.cost, got.audit, got.repaired_sha256) == (0, "KK", _sha(f"user:{long}\nassistant:ok."))


def test_agenda_is_lightest_over_random_segments():
    """Blocks joined as segments give what one agenda over all rows gives."""
    rng = random.Random(5)
    for _ in range(60):
        rows = [C.row_edits(rng.choice("usax"), rng.random() < 0.1, rng.random() < 0.2, rng.choice([1, 1, 2])) for _ in range(rng.randrange(1, 14))]
        k = rng.randrange(len(rows) + 1)
        one = C.lightest(rows, C.STATES)
        two = C.lightest([C.as_segment(C.lightest(rows[:k], C.STATES)), C.as_segment(C.lightest(rows[k:], C.STATES))], C.STATES)
        assert one == two


# ---------------------------------------------------------------- op12

def _fim(doc_id, text):
    text = text or ""
    n = len(text)
    own = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(own[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    spm = h4 % 100 < 20
    return doc_id, n, "spm" if spm else "psm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("units", [65_536, 7])
def test_fill_in_middle_against_python(spark, docs, texts, units):
    few = docs if units > 7 else docs.filter("length(text) < 3000 or text is null")
    odd = [(None, "no id €𝄞 here"), (None, None), (900, "<P> inside"), (900, "<M"), (901, "<"), (901, "a<S"), (902, "𝄞"), (903, "é" * 70_000), (904, "x" * 70_000)]
    odd += [(i, "<" * (i % 5) + "𝄞ß<S" * (i % 7)) for i in range(1000, 1150)]
    more = spark.createDataFrame([(i, t, "e", "s", 1, 1, "x", True) for i, t in odd], docs.schema)
    both = few.unionByName(more).unionByName(more.limit(3))
    rows = [tuple(r) for r in both.select("doc_id", "text").collect()]
    got = sorted(map(tuple, M.fim_digests(both, units=units).collect()), key=repr)
    want = sorted(((*_fim(i, t)[:5], _sha(_fim(i, t)[5]), _sha(t or "")) for i, t in rows), key=repr)
    assert got == want
    out: dict = {}
    for r in M.fim_pieces(both, units=units).collect():
        out.setdefault(r.row, []).append((r.place, bytes(r.piece)))
    assert sorted(b"".join(p for _, p in sorted(v)).decode() for v in out.values()) == sorted(_fim(i, t)[5] for i, t in rows)
    assert all(len(p.decode()) <= units + 3 for v in out.values() for _, p in v)


def test_fill_in_middle_of_empty_table(spark, docs):
    assert M.fim_digests(docs.limit(0)).count() == 0


def test_reader_finds_sentinels_cut_anywhere():
    for form, cuts in itertools.product(("psm", "spm"), range(1, 6)):
        order = M.ORDER[form]
        raw = b"".join(s + [b"pre<", b"mi<Sd", b""][part] for s, part in order)
        reader, got = M._Reader(form), {}
        for i in range(0, len(raw), cuts):
            for part, data in reader.read(raw[i:i + cuts]):
                got[part] = got.get(part, b"") + data
        assert b"".join(got[k] for k in sorted(got)) == b"pre<mi<Sd" or form == "psm"


# ---------------------------------------------------------------- op13

def _counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    grams: dict = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i:i + 3]), []).append(i)
    hit = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    forms = {f(w) for w in Q.STOP_WORDS for f in (str.lower, str.capitalize)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in Q.SYMBOLS for c in text), "n_exclaim": text.count("!"),
            "n_stop_words": sum(w in forms for w in words), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
            "n_bullet_lines": sum(x.strip(Q.SPACE)[0] in Q.BULLETS for x in lines),
            "n_ellipsis_lines": sum(x.strip(Q.SPACE).endswith(("...", "…")) for x in lines), "n_repeat_words": len(hit)}


def _verdict(m):
    names = lambda rules: [n for n, c, per, least, most in rules
                           if (least is not None and (100 * m[c] if per else m[c]) < least * (m[per] if per else 1))
                           or (most is not None and (100 * m[c] if per else m[c]) > most * (m[per] if per else 1))]
    base, rest = names(Q.BASE), names(Q.THRESHOLDS)
    return {"base_failed": bool(base), "kept": not base and not rest, "failed": ",".join(base + rest)}


def test_quality_rules_against_python(spark, docs, texts):
    odd = ["a b c a b c", "a b a b a b a b", "x\x0by\x0cz\r\nx\ty z", "- one\n* two\n• three…\n\n- one", "wait...\nwhat…  \n ...", "The the THE of!!", "#*$%&|<>", "\x85\xa0  "]
    more = spark.createDataFrame([(2000 + i, t, "e", "s", 1, 1, "x", True) for i, t in enumerate(odd)] + [(None, odd[0], "e", "s", 1, 1, "x", True)], docs.schema)
    both = docs.unionByName(more)
    got = Q.judge_rules(both)
    rows = [tuple(r) for r in both.select("doc_id", "text").collect()]
    want = []
    for i, t in rows:
        m = _counts(t)
        want.append({"doc_id": i, **m, **_verdict(m)})
    key = lambda d: repr(sorted(d.items()))
    assert sorted((r.asDict() for r in got.collect()), key=key) == sorted(want, key=key)
    kept = Q.keep_by_rules(both)
    assert kept.columns == both.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w["doc_id"] for w in want if w["kept"])
    assert Q.judge_rules(both.limit(0)).count() == 0
    assert {r.kept for r in Q.judge_rules(both, thresholds=[], base=[], stop_words=[]).collect()} == {True}


def test_quality_rules_are_one_projection(spark):
    plan = Q.judge_rules(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Join", "Aggregate"))
