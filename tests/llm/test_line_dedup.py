"""Line dedup against all pairs on whole results; short, long, odd and repeated lines; columns of any name."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import line_dedup as ld


def shingles(line):
    return {line[i : i + ld.WIDTH] for i in range(max(1, len(line) - ld.WIDTH + 1))}


def plain(rows, similarity=0.8):
    """{(doc_id, pos): the first place of its component} of all lines, by all pairs that share a shingle."""
    first, sets = {}, {}
    lines = []
    for doc_id, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for pos, line, worded in ld.normal_lines(text):
            name = (line, worded)
            lines.append(((doc_id, pos), name))
            first.setdefault(name, (doc_id, pos))
            if worded:
                sets[name] = shingles(line)
    parent = {n: n for n in first}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    holders = defaultdict(list)
    for name, own in sets.items():
        common = Counter(other for s in own for other in holders[s])
        for other, n in common.items():
            if n >= similarity * (len(own) + len(sets[other]) - n) - 1e-9:
                a, b = find(name), find(other)
                if a != b:
                    parent[b if first[a] < first[b] else a] = a if first[a] < first[b] else b
        for s in own:
            holders[s].append(name)
    return {place: first[find(name)] for place, name in lines}


def kept_lines(rows, stays):
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if stays.get((d, i), (d, i)) == (d, i)) for d, t in rows}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_result_against_all_pairs(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    stays = plain(rows)
    wanted = {p for p, first in stays.items() if p != first}
    got = {(r.doc, r.pos) for r in ld.duplicates(docs).collect()}
    assert not got - wanted and len(got) >= 0.995 * len(wanted) > 20
    if got == wanted:
        assert {r.doc_id: r.text for r in ld.without_repeated_lines(docs).collect()} == kept_lines(rows, stays)


def test_recall_at_the_threshold_by_length(spark):
    """Pairs of similarity 0.8 to 0.9, of short lines, lines about the border of the two signatures, and long ones."""
    random = np.random.default_rng(5)
    word = lambda: "".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), random.integers(3, 9)))
    docs, wanted = [], 0
    for n, size in enumerate([6] * 150 + [18] * 150 + [22] * 150 + [90] * 150):
        words = [word() for _ in range(size)]
        near = list(words)
        for at in random.choice(size, max(1, size // 12), replace=False):
            near[at] = near[at][:-1] + "9"
        a, b = " ".join(words), " ".join(near)
        alike = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        if 0.8 <= alike < 0.9:
            docs += [(2 * n, a), (2 * n + 1, b)]
            wanted += 1
    assert wanted > 100
    assert ld.duplicates(spark.createDataFrame(docs, "doc_id long, text string")).count() >= 0.985 * wanted


def test_similarity_is_exact():
    random = np.random.default_rng(2)
    lines = ["".join(random.choice(list("ab "), random.integers(1, 60))) for _ in range(200)] + ["x", "", "ünïcödé" * 30, "a" * 3000]
    others = lines[1:] + lines[:1]
    want = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for a, b in zip(lines, others)]
    assert np.allclose(ld.similarities(lines, others), want)
    assert np.allclose(ld.similarities(lines, lines), 1)


def test_pieces_of_very_long_lines_change_nothing(monkeypatch):
    random = np.random.default_rng(3)
    lines = ["".join(random.choice(list("abcdef "), n)) for n in (5000, 20, 700, 4000, 3)]
    keys, alike = [k.tolist() for k in ld.band_keys(lines)], ld.similarities(lines, lines[::-1])
    monkeypatch.setattr(ld, "CHARS", 500)
    assert [k.tolist() for k in ld.band_keys(lines)] == keys and np.allclose(ld.similarities(lines, lines[::-1]), alike)


LONG = "one very long line of words " * 20_000
ODD = [
    (1, "Read more here\nfirst of all\n\n  \n---\n***"), (2, "read MORE here!\n---\n--- ---"), (3, None), (4, ""), (5, "\n\n\n"), (6, "a\nb\na\nA."), (6, "a\nb\na\nA."), (7, "x"),
    (None, "first of all\nRead more here"), (8, LONG + "\n" + LONG), (9, LONG.replace("words", "wordy", 3)), (10, "é\x00\ud800".encode("utf-8", "replace").decode() + "\nfirst_of__all"), (11, "日本語の行です。\n日本語の行です"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(d, t, 1) for d, t in ODD], "doc_id long, text string, `a.b` int").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in ld.without_repeated_lines(docs).collect()), key=str)
    want = kept_lines([r for r in ODD if r[0] is not None], plain(list(dict.fromkeys(r for r in ODD if r[0] is not None))))
    assert got == sorted([(d, want[d]) if d is not None else (d, t) for d, t in ODD], key=str)
    assert want[2] == "--- ---" and want[6] == "a\nb" and want[8] == LONG and want[9] == ""


def test_columns_of_any_name(spark):
    names = ["doc_id", "a.b", "_doc", "_gone", "_bits", "_lines", "_removed", "text", "doc", "text_hash", "both", "c0", "gone", "node", "place", "lines"]
    row = lambda d, t: tuple(t if c == "text" else d if c == "doc_id" else f"{c}-{d}" for c in names)
    layout = ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in names)
    docs = spark.createDataFrame([row(1, "same line here"), row(2, "same line here\nother"), row(3, "unlike")], layout)
    got = ld.without_repeated_lines(docs)
    assert got.columns == names and sorted(map(tuple, got.collect())) == [row(1, "same line here"), row(2, "other"), row(3, "unlike")]
    told = ld.dedup_lines(docs)
    assert told.columns == [c for c in names if c not in ("_lines", "_removed")] + ["_lines", "_removed"]
    assert sorted((r.doc_id, r["_lines"], r["_removed"]) for r in told.collect()) == [(1, 1, 0), (2, 2, 1), (3, 1, 0)]
    assert ld.without_repeated_lines(docs.where("doc_id > 9")).count() == 0


def test_large_groups_of_near_copies(spark):
    """Thousands of lines that differ in one word each, and as many that share half of their text with all others."""
    common = " ".join(f"word{i}" for i in range(60))
    near = [(i, f"{common} number {i}") for i in range(1500)]
    half = " ".join(f"part{i}" for i in range(30))
    apart = [(5000 + i, half + " " + " ".join(hashlib.md5(f"{i} {j}".encode()).hexdigest() for j in range(8))) for i in range(300)]
    docs = spark.createDataFrame(near + apart, "doc_id long, text string").repartition(8)
    assert {r.doc for r in ld.duplicates(docs).collect()} == set(range(1, 1500))


def test_links_beside_a_buckets_first_and_last_place(spark):
    """Similar sets that are unlike their bucket's first and last place, that are linked through others, in blocks too."""
    sets = {1: [900, 901], 2: [1, 2, 3, 4, 5], 3: [1, 2, 3, 4, 5, 6], 4: [2, 3, 4, 5, 6, 7], 5: [50, 51], 9: [990, 991]}
    apart = {100 + i: [10 * i + 1000, 10 * i + 1001] for i in range(12)}
    raw = spark.createDataFrame([*sets.items(), *apart.items()], "place long, raw array<long>")
    bands = spark.createDataFrame([(p, 7) for p in sets] + [(p, 8) for p in (2, 3, 4)] + [(p, 9) for p in [0, 3, 4, *apart, 999]], "place long, key long")
    wanted = lambda places: raw.join(places, "place")
    for block in (1024, 3):
        ld.BLOCK, before = block, ld.BLOCK
        try:
            found = {r.node: r.component for r in ld.linked(bands, wanted, 5 / 7, ld.verified_sets).collect()}
            assert found == {2: 2, 3: 2, 4: 2}
            found = {r.node: r.component for r in ld.linked(bands.where("key = 7"), wanted, 0.8, ld.verified_sets).collect()}
            assert found == {2: 2, 3: 2}
        finally:
            ld.BLOCK = before


def test_lines_that_share_keys_with_unlike_lines(spark, monkeypatch):
    """All lines in one bucket, so that most are unlike its first and last one: the result is that of all pairs."""
    monkeypatch.setattr(ld, "signed_bands", lambda lines: lines.where("kinds > 0").select(ld.F.col("node").alias("place"), ld.F.lit(1).cast("long").alias("key"), ld.F.lit(0).cast("long").alias("sketch")))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    wanted = {p for p, first in plain(rows).items() if p != first}
    assert {(r.doc, r.pos) for r in ld.duplicates(docs).collect()} == wanted


def test_unlike_pairs_of_a_bucket_are_left_out_before_their_texts_are_compared(spark, monkeypatch):
    """Lines just below the threshold with all others: the bits rule out nearly all pairs, and no similar one."""
    common = " ".join(f"word{i}" for i in range(24))
    apart = [(i, common + " " + hashlib.md5(f"{i}".encode()).hexdigest() * 2) for i in range(60)]
    rows = [*apart, (70, apart[30][1] + "x"), (71, apart[40][1][:-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    compared, verify = [], ld.verified_lines
    monkeypatch.setattr(ld, "verified_lines", lambda pairs, *more: compared.append(pairs.count()) or verify(pairs, *more))
    monkeypatch.setattr(ld, "_agree", lambda a, b: ld.F.lit(True))
    assert {r.doc for r in ld.duplicates(docs).collect()} == {70, 71}
    assert 2 <= sum(compared) < 60


def test_bits_never_rule_out_similar_lines():
    random = np.random.default_rng(4)
    for size in (1, 4, 40, 400, 4000):
        a = ["".join(random.choice(list("abcdefgh "), size)) for _ in range(20)]
        b = [x[: len(x) // 2] + "zz" + x[len(x) // 2 + int(n) :] for n, x in enumerate(a)]
        (n_a, bits_a), (n_b, bits_b) = ld.flipped(a), ld.flipped(b)
        differing = np.bitwise_count((bits_a ^ bits_b).view(np.uint64)).sum(axis=1)
        alike = ld.similarities(a, b)
        assert (n_a == [len(shingles(x)) for x in a]).all()
        assert (differing * (1 + alike) <= (n_a + n_b) * (1 - alike) + 1e-6).all()
