"""The pipeline's stages on odd rows, repeated rows and empty tables, and the whole run over a small folder."""

import pytest

import corpus_pipeline

LAYOUT = "doc_id long, text string, lang string, source string, n_chars int, `a.b` string, `gone` int, `place` long"
LINE = "the keeper of the light wrote each evening into a small blue book how many ships had passed the rocks"
ITEM = "a farmer sells twelve brown eggs on monday then walks home and rests a while until the cool evening comes"


def documents():
    rows = [(i, f"{LINE} number {i} and nothing else was said about {i * i}", "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, None, "en"), (101, "", "en"), (102, " \n ", None), (103, "½ ² ①", "en"), (104, LINE, None), (104, LINE, None), (None, LINE + " once more", "en")]
    rows += [(105, "word " * 30_000, "en"), (106, "long" * 20_000, "en"), (107, f"So it goes. {ITEM} and so on.", "en"), (108, f"{LINE}\n{LINE}\nshort\nshort", "en")]
    return [(d, t, lang, "s", 1, "x", 2, 3) for d, t, lang in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(documents(), LAYOUT).repartition(3).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame([(1, ITEM), (2, None), (None, ITEM), (3, "")], "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
    return str(at)


def test_each_stage_takes_odd_rows_and_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out, none = stage(spark, docs, folder), stage(spark, docs.where("doc_id > 999"), folder)
        assert none.count() == 0 and none.columns == out.columns, name
        rows = out.collect()
        assert {r.doc_id for r in rows} <= {d[0] for d in documents()}, name
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns and all((r["a.b"], r["gone"], r["place"]) == ("x", 2, 3) for r in rows), name


def test_what_the_stages_take_out(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, folder).select("doc_id").collect()}
    assert not kept & {100, 101, 102, 103} and 107 in kept
    lines = {r.doc_id: r.text for r in corpus_pipeline.line_dedup_stage(spark, docs, folder).collect()}
    assert lines[100] is None and lines[101] == "" and lines[108] == "short" and lines[None] == LINE + " once more"
    one = [r.doc_id for r in corpus_pipeline.simhash_stage(spark, docs, folder).collect()]
    assert one.count(104) == 1 and None in one and 107 in one
    assert 107 not in {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, folder).collect()}


def test_the_whole_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert 107 not in ids and 105 in ids and out.where("not round_trip").count() == 0
