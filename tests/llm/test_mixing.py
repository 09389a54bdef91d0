"""The mix against targets, multipliers and rounding computed plainly; odd rows; reruns."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import mixing, queries


def plain(rows, weights=(5, 2, 1), share=1.5, most=2):
    """rows of (source, text): target and {size: (documents, copies)} of each source."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows]
    names = sorted({s for s, _ in rows}, key=lambda s: (s is None, s or ""))
    whole = {s: sum(n for (o, _), n in zip(rows, size) if o == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, share * sum(size), list(names)
    while free:
        unit = left / sum(weight[s] for s in free)
        above = [s for s in free if unit * weight[s] >= most * whole[s]]
        if not above:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in above:
            target[s] = float(most * whole[s])
            left -= target[s]
            free.remove(s)
    out = {}
    for s in names:
        counts = Counter(n for (o, _), n in zip(rows, size) if o == s)
        sizes, n = np.array(sorted(counts, reverse=True)), np.array([counts[k] for k in sorted(counts, reverse=True)])
        mean = whole[s] / n.sum()
        if not whole[s]:
            rate = np.full(len(n), most / 2)
        elif target[s] >= most * whole[s]:
            rate = np.full(len(n), float(most))
        else:
            low, high = -1e4, 1e4
            with np.errstate(over="ignore"):
                for _ in range(200):
                    theta = (low + high) / 2
                    rate = most / (1 + np.exp(-theta * sizes / mean))
                    low, high = (low, theta) if (n * sizes * rate).sum() > target[s] else (theta, high)
        owed, copies = target[s] - float((n * sizes * rate).sum()), []
        for z, k, r in zip(sizes.tolist(), n.tolist(), rate.tolist()):
            given = min(max(int(k * r + (owed / z if z else 0) + 0.5), 0), most * k)
            owed += (k * r - given) * z
            copies.append(given)
        out[s] = (whole[s], target[s], {z: (k, c) for z, k, c in zip(sizes.tolist(), n.tolist(), copies)})
    return out


def check(mixed, rows):
    want = plain(rows)
    got = defaultdict(lambda: defaultdict(list))
    for r in mixed:
        got[r.source][r.size].append(r.copies)
        whole, target, sizes = want[r.source]
        assert r.source_size == whole and r.target == pytest.approx(target) and r.taken == r.copies * r.size <= 2 * r.size
        n, copies = sizes[r.size]
        assert r.copies in (copies // n, -(-copies // n))
    assert {s: {z: (len(c), sum(c)) for z, c in by.items()} for s, by in got.items()} == {s: sizes for s, (_, _, sizes) in want.items()}


def frame(spark, rows):
    layout = "doc_id long, source string, text string, size string, copies int, `rank` int, `key` string, `a.b` int, lang string"
    return spark.createDataFrame([(i % 90 if i % 50 else None, s, t, "x", -1, 5, "k", 3, "en") for i, (s, t) in enumerate(rows)], layout).repartition(3)


ODD = [("a", "one two three"), ("a", "one\x0btwo x  "), ("b", None), ("b", ""), (None, "no source here"), (None, None), ("", "empty name"), ("Z", "w " * 30_000), ("é", "x"), ("é", "x y " * 40)] + [("c", "same text again")] * 60


def test_odd_rows(spark):
    check(mixing.mix(frame(spark, ODD)).collect(), ODD)
    assert mixing.mix(frame(spark, ODD).where("doc_id > 999")).count() == 0
    nothing = [("a", None), ("b", " ")]
    assert [(r.size, r.target, r.taken) for r in mixing.mix(frame(spark, nothing)).collect()] == [(0, 0.0, 0)] * 2


def test_given_documents_against_plain_rounding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.source, r.text) for r in docs.select("source", "text").collect()]
    mixed = mixing.mix(docs).collect()
    check(mixed, rows)


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    folder = "/root/testdata/sf0.01"
    first, again = (sorted(map(tuple, queries.op12_mixing(spark, folder).collect())) for _ in range(2))
    assert first == again
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source").collect()}
    taken, target = defaultdict(int), {}
    for doc_id, size, _, wanted, words, *_ in first:
        assert 0 <= words <= 2 * size
        taken[source[doc_id]] += words
        target[source[doc_id]] = wanted
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r[1] for r in first))


def test_copies_are_whole_rows(spark):
    mixed = mixing.mix(frame(spark, ODD), more=("text", "a.b"))
    assert mixed.columns == ["doc_id", "text", "a.b", "source", "size", "source_size", "target", "rate", "copies", "taken"]
    assert mixing.repeated(mixed).count() == sum(r.copies for r in mixed.collect())
