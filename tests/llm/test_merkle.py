"""The manifest against a plain recursive tree and its SQL; odd rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from oracle_check import difference, duck
from tidemark.llm import merkle, oracles, queries, ranks


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """(top, for each node the steps (before, after) up to it), level by level."""
    paths, at, now = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(now) > 1:
        runs = [now[i : i + 8] for i in range(0, len(now), 8)]
        for k, i in enumerate(at):
            run = runs[i // 8]
            paths[k].append((run[: i % 8], run[i % 8 + 1 :]))
            at[k] = i // 8
        now = [H("".join(run)) for run in runs]
    return (now or [None])[0], paths


def plain(rows):
    """rows of (doc_id, source, lang, n_chars, text): what the query should return."""
    leaves = [(r, H("".join(map(value, r)))) for r in rows]
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r, _ in leaves}, key=lambda v: (v is not None, (v or "").encode()))
    groups = {lang: sorted((x for x in leaves if x[0][2] == lang), key=lambda x: (first(x[0][0]), x[1])) for lang in langs}
    trees = {lang: tree([leaf for _, leaf in g]) for lang, g in groups.items()}
    root, over = tree([trees[lang][0] for lang in langs])
    out = []
    for lang, up in zip(langs, over):
        for (r, leaf), path in zip(groups[lang], trees[lang][1]):
            steps = path + up
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = H("".join(map(value, (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))))
            for before, after in steps:
                node = H("".join(before) + node + "".join(after))
            out.append((r[0], leaf, trees[lang][0], root, H("".join("".join(b + a) for b, a in steps)), node, node == root))
    return sorted(out, key=str)


def table(spark, tmp_path, rows, name="documents"):
    layout = "doc_id long, source string, lang string, n_chars int, text string, `own` int, `group` string, `proof` string, `_at` long, `a.b` int"
    spark.createDataFrame([(*r, 1, "g", "p", 7, 2) for r in rows], layout).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def found(spark, folder):
    return sorted(map(tuple, queries.op11_merkle(spark, folder).collect()), key=str)


ODD = [
    (1, "s", "en", 5, "Hello"), (2, None, "en", None, None), (3, "s", None, 0, ""), (None, "s", None, 3, "No id"), (None, None, None, None, None),
    (5, "s", "de", 4, "Äpfel"), (6, "s", "Ω", 4, "ABC"), (6, "s", "Ω", 4, "ABC"), (6, "s", "Ω", 4, "abd"), (7, "s", "en", 9, "Long WORDS " * 30_000), (0, "s", "", 1, "Z"), (-4, "s", "de", 1, "q"),
]


def test_odd_rows(spark, tmp_path):
    assert found(spark, table(spark, tmp_path, ODD)) == plain(ODD)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65, 513])
def test_sizes(spark, tmp_path, n):
    rows = [(i * 7 % 1009, f"s{i % 3}", "xx" if i % 5 else "yy", i, f"Text {i}") for i in range(n)]
    assert found(spark, table(spark, tmp_path, rows)) == plain(rows)


def test_groups_of_several_storeys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle._leaves, "__defaults__", (1,))
    rows = [(i, "s", "xx" if i % 50 else f"l{i}", i, f"Text {i}") for i in range(700)]
    assert found(spark, table(spark, tmp_path, rows)) == plain(rows)


def test_against_sql_and_the_changed_rows(spark, sf):
    con = duck(sf)
    assert difference(queries.op11_merkle(spark, sf), con, oracles.SQL["op11_merkle"]) is None
    got = queries.op11_merkle(spark, sf).select("doc_id", "verified").toPandas().set_index("doc_id").verified
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for d, t in text.items():
        assert got[d] == (zlib.crc32(str(d).encode()) % 3 != 0 or not any("A" <= c <= "Z" for c in t))


def test_proofs_of_the_manifest_hold(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", merkle.leaf_of(F.col("text")).alias("leaf"))
    made = merkle.manifest(docs, "lang", "doc_id")
    assert made.columns == ["doc_id", "leaf", "lang", "subroot", "root", "proof"]
    assert made.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert made.where(merkle.fold(F.lit("x"), F.col("proof")) == F.col("root")).count() == 0


def test_ranks_with_ties_and_null_groups(spark):
    rows = [(g, k, i) for i, (g, k) in enumerate([(None, 1), ("a", 2), ("a", None), ("a", 2), (None, None), ("b", 5)] * 40)]
    got = ranks.ranked(spark.createDataFrame(rows, "g string, k int, v int").repartition(5), ["g"], ["k"]).collect()
    for g, n in ((None, 80), ("a", 120), ("b", 40)):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(n)) and {r.total for r in mine} == {n}
        keys = [-1 if r.k is None else r.k for r in mine]
        assert keys == sorted(keys) and len({r.v for r in mine}) == n
