from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import prose
from weftline.llm.queries import ORACLE_SQL, QUERIES


def test_stages(spark, tmp_path):
    sf = str(tmp_path)
    good = [(k, prose(k, 120)) for k in range(40)]
    junk = [(100 + k, " ".join(w + "***" for w in prose(100 + k, 120).split())) for k in range(40)]
    near = prose(0, 120).split()
    near[100] = "edit"
    bench = prose(900, 30)
    made = [*good, *junk, (200, " ".join(near)), (201, bench + " " + prose(901, 100)), (202, prose(3, 120) + "\n" + prose(902, 60)), (203, prose(903, 70) + "\n" + prose(902, 60)), (204, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in made], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good[5:] + junk[5:]], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    ids = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf)
        if k < 4:
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        docs.write.parquet(f"{sf}/out{k}")
        docs = spark.read.parquet(f"{sf}/out{k}")
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    keep = {i for i, _ in good} | {200, 201, 202, 203}
    assert ids[0] == keep and ids[1] == keep
    assert ids[2] == keep - {200} and ids[3] == keep - {200, 201} and ids[4] == ids[3]
    lines = {r.doc_id: r for r in spark.read.parquet(f"{sf}/out1").collect()}
    assert lines[203].text == prose(903, 70) and lines[203].n_chars == len(lines[203].text)


def test_run_on_awkward_tables(spark, docs, no_docs, tmp_path, monkeypatch):
    from weftline.llm import common

    monkeypatch.setattr(common, "scratch_root", lambda _: f"file://{tmp_path}/scratch")
    for name, documents in (("some", docs), ("none", no_docs)):
        sf = f"{tmp_path}/{name}"
        documents.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (None, 0, 0), (4, None, None)] if name == "some" else [], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(None, None), (1, "")] if name == "some" else [], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        got = corpus_pipeline.run(spark, sf).collect()
        assert {p.name for p in tmp_path.glob("scratch/weftline/*/*")} == {"best_fit_packing"}  # all else is deleted
        common.release(spark)
        # Long enough and without many repeats; of the copy, line dedup leaves an empty text, which links with nothing.
        assert sorted((r.doc_id or 0, r.length > 1) for r in got) == ([(0, True), (1, True), (2, False), (4, True), (5, True)] if name == "some" else [])


def test_registered():
    assert {int(n.split("_")[0][2:]) for n in QUERIES} == set(range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES)
