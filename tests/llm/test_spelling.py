"""Near words, forms and roots against all pairs, and the query against its SQL; odd rows."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oracle_check import difference, duck
from tidemark.llm import oracles, queries, spelling


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, factor=5):
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= factor * counts[w]}
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out)


def words_of(rows, deleted=199):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if deleted and h % deleted == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= 6
    return {w: n for w, n in found.items() if n >= 5}


def grouped(spark, counts):
    return sorted(map(tuple, spelling.grouped(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)).collect()))


def test_chains_ties_and_runs_of_equal_letters(spark):
    counts = {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 200, "aaaaaaaaa": 1000, "aabaaa": 25, "abaaaa": 25, "aaaaab": 26, "baaaaa": 26, "zzzzzz": 7, "étéété": 9, "eteete": 9, "étéete": 50}
    assert grouped(spark, counts) == plain(counts)


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=3, max_size=6), st.integers(5, 400), min_size=1, max_size=120))
def test_any_words_against_all_pairs(spark, counts):
    assert grouped(spark, counts) == plain(counts)


def test_long_words_go_by_hashes(spark, monkeypatch):
    """Words around the length where keys become hashes, and the same words wholly by hashes."""
    base = "abcdefghij" * 7
    long = {base[:n]: 5 + 30 * n for n in (62, 63, 64, 65, 66, 67)} | {base[:20] + "z" + base[21:n]: n for n in (63, 64, 65, 66)} | {"a" * n: 10**n for n in range(3, 7)}
    assert grouped(spark, long) == plain(long)
    monkeypatch.setattr(spelling, "PLAIN", 2)
    short = {"aaaaaa": 5, "aaaaaaa": 30, "aabaaa": 25, "étéété": 9, "eteete": 9, "étéete": 50, "abcdef": 7, "abdef": 100, "xabdef": 9}
    assert grouped(spark, short | long) == plain(short | long)


ODD = [
    (1, "Straße straße STRASSE Étonnant étonnant ×÷×÷×÷×"), (None, "nothing else nothing"), (2, None), (3, ""), (4, "12 34 !!"), (5, "İstanbul istanbul"),
    (6, "letter " * 4000 + "lettre " * 30), (6, "letter " * 4000 + "lettre " * 30), (7, "leter lettter better bettér " * 50), (8, "x" * 50_000 + " short"),
]


@pytest.mark.parametrize("deleted", [199, 3, None])
def test_odd_rows(spark, deleted):
    layout = "doc_id long, text string, word int, n int, `key` string, `open` int, `a.b` int"
    docs = spark.createDataFrame([(*r, 1, 2, "k", 3, 4) for r in ODD * 5], layout).repartition(3)
    want = plain(words_of(ODD * 5, deleted))
    assert len(want) > 5
    assert sorted(map(tuple, spelling.grouped(spelling.counted(spelling.occurrences(docs, deleted=deleted))).collect())) == want
    assert spelling.grouped(spelling.counted(spelling.occurrences(docs.where("doc_id > 99")))).count() == 0


def test_groups_stay_small(spark):
    """However many words share a pattern, a key holds one word per letter and one whole rotation."""
    alphabet = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    words = ["lette" + a + b for a in alphabet for b in alphabet[:30]] + ["letter"]
    assert spelling.keys(spark.createDataFrame(list(enumerate(words)), "id long, word string")).groupBy("key").count().agg({"count": "max"}).first()[0] <= len(alphabet) + 1


def test_query_against_its_sql_and_all_pairs(spark, sf):
    assert difference(queries.op13_spelling(spark, sf), duck(sf), oracles.SQL["op13_spelling"]) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op13_spelling(spark, sf).collect())) == plain(words_of(rows))
