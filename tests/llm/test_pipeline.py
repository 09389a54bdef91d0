"""The pipeline's stages: columns, and what each lets through."""

import corpus_pipeline


def test_stages(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    start = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == start.columns
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
    assert docs.where("not round_trip").count() == 0


def test_near_copies_go(spark):
    """Recall on near copies by five-word shingles, and what is less alike stays."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = [r.text.split() for r in table.orderBy("doc_id").collect() if r.text and 100 <= len(r.text.split()) <= 600][:150]
    shingles = lambda w: {" ".join(w[i : i + 5]).lower() for i in range(len(w) - 4)}
    alike = lambda a, b: len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    near = [[f"new{j}" if j % 80 == 40 + i % 9 else w for j, w in enumerate(words)] for i, words in enumerate(texts)]
    far = [[f"new{j}" if j % 12 == 5 else w for j, w in enumerate(words)] for words in texts]
    pairs = [(i, a, b) for i, (a, b) in enumerate(zip(texts, near)) if 0.8 <= alike(a, b) < 1]
    assert len(pairs) > 100
    rows = [x for i, a, b in pairs for x in ((i, " ".join(a)), (1000 + i, " ".join(b)))]
    rows += [(2000 + i, " ".join(w)) for i, w in enumerate(far)]
    kept = {r.doc_id for r in corpus_pipeline.simhash_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert not {d for d in kept if 1000 <= d < 2000}
    assert len({d for d in kept if d >= 2000}) > 100


def test_close_fingerprints_are_candidates(spark, monkeypatch):
    """By fingerprints alone: all similar pairs within three bits are found, equal fingerprints alone make no link."""
    import numpy as np

    from tidemark.llm import simhash

    random = np.random.default_rng(8)
    pairs, rows = [], []
    for i in range(40):
        words = [f"w{n}" for n in random.integers(0, 100_000, 900)]
        near = [*words[:450], f"new{i}", *words[451:]]
        a, b = (simhash.majority(simhash.shingle_set(" ".join(w), 5, {})) for w in (words, near))
        pairs.append((i, (a ^ b).bit_count()))
        rows += [(i, " ".join(words)), (1000 + i, " ".join(near))]
    close = {1000 + i for i, bits in pairs if bits <= 3}
    assert len(close) > 15
    real = simhash.linked
    monkeypatch.setattr(simhash, "linked", lambda bands, *rest, **more: real(bands.where("sketch is not null"), *rest, **more))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()}
    assert kept == {d for d, _ in rows} - close
    monkeypatch.setattr(simhash, "value_of", lambda fp, bits: simhash.F.lit(0).cast("long"))
    assert {r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()} == kept


def test_workers_give_back_what_is_free():
    """Freed blocks below some that are still held go back to the system at a task's end; rows pass unchanged."""
    from tidemark.llm.common import lean

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    held = []

    def run(batches):
        blocks = [b"x" * 60_000 for _ in range(4000)]
        held.extend(blocks[::50])
        yield from batches

    before = resident()
    assert list(lean(run)(iter([1, 2, 3]))) == [1, 2, 3]
    assert resident() - before < 100_000_000 and len(held) == 80
    held.clear()
    assert list(run(iter([1]))) == [1] and resident() - before > 150_000_000  # without it


def test_no_fingerprints_plan_few_probes(spark):
    from tidemark.llm import simhash

    layout, thresholds = simhash.plan(spark.createDataFrame([], "fp long"), 3)
    assert sum(len(simhash._flips(bits, t)) for bits, t in zip(layout, thresholds) if t >= 0) <= 5
