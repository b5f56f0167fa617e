"""URL rules, exact dedup and licence scans: SQL oracles, plain-Python twins, edge cases."""

from __future__ import annotations

import hashlib
import re
import textwrap

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest
from zonepace.llm import exact_dedup as X
from zonepace.llm import license_scan as L
from zonepace.llm.oracle import ORACLE
from zonepace.llm.queries import QUERIES, URL_RULES
from zonepace.llm.url_filter import judge_urls, rules_table


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(cols, cur.fetchall())


def _judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host):]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules_against_python(spark):
    rules = [*URL_RULES, ("a.com", "/x", "block"), ("a.com", "/x/y/z", "allow"), ("b.a.com", "/", "allow"), ("com", "/long/path/", "block")]
    urls = [None, "", "no scheme", "http://", "http://COM", "http://com/", "https://example.com/en/1", "https://WWW.example.com/en/",
            "http://x.www.example.com/en/a?b=/c", "http://notexample.com/en/", "http://net/es/", "http://a.net/es", "http://a.net/fr/#x",
            "http://a.com/xylophone", "http://q.b.a.com/x/y/z/1", "http://b.a.com?x=/x", "http://É.Com/long/path/deep", "http://..com/", "a://b://c.net/es/",
            "http://u:p@a.com:80/x", "http://a.com/" + "d/" * 3000, "http://" + "s." * 400 + "com/en/"] * 2
    pages = spark.createDataFrame([(i // 2, u, "rule", i) for i, u in enumerate(urls)], "page_id long, url string, rule string, host long")
    got = sorted(map(tuple, judge_urls(pages, rules_table(spark, rules)).collect()), key=repr)
    want = sorted(((i // 2, *_judge(u, rules)) for i, u in enumerate(urls)), key=repr)
    assert got == want
    assert judge_urls(pages.limit(0), rules_table(spark, rules)).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules_table(spark, [])).collect()} == {"allow"}


@pytest.mark.parametrize("bits", [64, 4])
def test_exact_dedup_against_python(spark, docs, texts, bits):
    """With 4-bit identifiers most chunks collide; the verified ordinals must still tell them apart."""
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    first = {}
    for i, t in enumerate(norm):
        first.setdefault(t, []).append(i)
    want = {(i, first[t][0], len(first[t]), i == first[t][0], hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(norm)}
    assert {tuple(r) for r in X.exact_dedup(docs, bits=bits).collect()} == want


def test_exact_dedup_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a\tb"), (2, "a  b"), (None, "a b"), (None, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.exact_dedup(df).collect()), key=repr)
    assert got == sorted([(1, 1, 4, True), (1, 1, 4, True), (2, 1, 4, False), (None, 1, 4, False), (None, None, 1, True)], key=repr)
    assert X.exact_dedup(df.limit(0)).count() == 0


def _grams(unit):
    w = unit.split()
    return {(a, b) for a, b in zip(w, w[1:])}


def _best(words, templates, spans):
    """Highest Dice of each template over the given spans of words."""
    best = {}
    for lo, hi in spans:
        g = set(zip(words[lo:hi], words[lo + 1:hi]))
        for no, m in templates:
            best[no] = max(best.get(no, 0), round(2 * len(g & m) / (len(g) + len(m)), 9) if g else 0)
    return best


def _wrap(text, width=60):
    return "\n".join(textwrap.wrap(text, width))


def test_license_scan_against_python(spark, docs, texts):
    """Every template that brute force over all lines, paragraphs, texts and all whole windows of its length finds is found."""
    mit, gpl = (next(c for a, _, c in L.TEMPLATES if a == name and len(c) > 450) for name in ("MIT", "GPL"))
    mit = max((c for a, _, c in L.TEMPLATES if a == "MIT"), key=len)
    prose = [t for t in texts if t and 200 < len(t) < 2000]
    rows = list(enumerate([
        None, "", "!!!", "one", prose[0],
        "Released under the MIT License.", "licensed UNDER the mit-license", "x\nLicensed under CC BY-NC 4.0.\ny", "All rights reserved",
        "This work is licensed under the GNU General Public License, version 3!", "Licensed under\nthe MIT License.",
        "Some prose. Released under the MIT License. More prose.", mit, _wrap(mit), f"{prose[1]}\n\n{_wrap(mit)}\n\n{prose[2]}",
        f"{prose[1]} {mit} {prose[2]}", _wrap(gpl, 40) + "\r\n\r\n" + prose[3], " * " + _wrap(gpl).replace("\n", "\n * "),
        mit.replace("without restriction", "with some added words here and no restriction"), mit[:len(mit) // 4], mit[:-60],
        "rights reserved", "All rights\nreserved, all rights reserved."]))
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", lower(t))
    sized = [(no, len(words(c)), _grams(" ".join(words(c)))) for no, (_, _, c) in enumerate(L.TEMPLATES)]
    templates = [(no, m) for no, _, m in sized]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, license string, kind int")
    found = {i: {} for i, _ in rows}
    for r in L.find_licenses(df).collect():
        found[r.doc_id][r.t_no] = max(found[r.doc_id].get(r.t_no, 0), r.dice)
    for i, t in rows:
        flat = re.sub(r"[^0-9a-z\n\x80-\U0010ffff]+", " ", lower(t))
        want = {}
        for unit in [*flat.split("\n"), *re.split("\n ?\n[ \n]*", flat), flat]:
            for no, dice in _best(words(unit), templates, [(0, len(words(unit)))]).items():
                want[no] = max(want.get(no, 0), dice)
        w = words(t)
        clipped = dict(want)
        for no, size, m in sized:
            for most, spans in ((want, range(len(w) - size + 1)), (clipped, range(1 - size, len(w)))):
                most[no] = max(most.get(no, 0), _best(w, [(no, m)], [(max(0, s), s + size) for s in spans]).get(no, 0))
        want = {no: dice for no, dice in want.items() if dice >= L.THRESHOLD}
        assert set(want) <= set(found[i]), (i, t)
        assert all(L.THRESHOLD <= dice <= clipped[no] for no, dice in found[i].items()), (i, t)
        if i in (12, 13, 14, 15):
            assert found[i][max(want, key=want.get)] == 1
    table = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    bsd = {a: c for a, _, c in L.TEMPLATES if a in ("BSD-2-Clause", "BSD-3-Clause")}
    full = spark.createDataFrame([(a, f"{prose[0]}\n{_wrap(c)}\n{prose[1]}") for a, c in bsd.items()], "doc_id string, text string")
    assert all(r.license == r.doc_id and r.unit == "window" and r.dice == 1 for r in L.scan_licenses(full).collect())
    assert [table[i].license for i in (5, 7, 9, 10, 11, 12, 13, 14, 15, 16, 17)] == [
        "MIT", "CC-BY-NC-4.0", "GPL-3.0", "MIT", "MIT", "MIT", "MIT", "MIT", "MIT", "GPL", "GPL"]
    assert all(table[i].license is None and table[i].licenses == "" and table[i].n_hits == 0 for i in range(5))
    assert table[14].unit == "paragraph" and table[15].unit == "window"
    assert L.scan_licenses(docs).filter("license IS NOT NULL").isEmpty()
    # Repeated rows and null ids share their findings; a very long text is read to its end.
    more = [(None, mit), (None, "x"), (7, mit), (7, mit), (8, "word " * 400_000 + mit)]
    got = L.scan_licenses(spark.createDataFrame(more, "doc_id long, text string")).collect()
    assert len(got) == 5 and {r.license for r in got} == {"MIT"} and len({r.n_hits for r in got if r.doc_id == 7}) == 1
    assert L.scan_licenses(df.limit(0)).count() == 0
    assert L.scan_licenses(df, templates=[]).filter("license IS NOT NULL").isEmpty()
