from __future__ import annotations

import gzip
import json
import math

import pytest

from pyspark.sql import functions as F

from weftline.functions import authority
from weftline.operators import classify, extract, graph, lookup, metrics, relations, sampling, spans
from weftline.sources import documents as sources
from weftline.streaming import landing


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_overlaps_by_column(spark):
    df = spark.sql("SELECT array(named_struct('start', 0, 'stop', 3), named_struct('start', 2, 'stop', 9), named_struct('start', 9, 'stop', 10), named_struct('start', 1, 'stop', 2)) AS s")
    assert [tuple(x) for x in df.select(spans.drop_overlaps(F.col("s")).alias("s")).first().s] == [(1, 2), (2, 9), (9, 10)]
    assert df.select(spans.drop_overlaps(F.slice("s", 1, 0)).alias("s")).first().s == []


def test_nearest_side_ties_go_back(spark):
    pairs = spark.createDataFrame([(1, 10, 12, 5, 7), (1, 10, 12, 15, 16), (2, 10, 12, 13, 14), (2, 10, 12, 1, 2)], "cue int, cs int, ce int, rs int, re int")
    assert rows(spans.nearest_side(pairs, ["cue"], "cs", "ce", "rs", "re").select("cue", "rs", "side", "distance")) == [(1, 5, "back", 3), (2, 13, "ahead", 1)]


def test_passes_in_order_equal_pairs(spark):
    """The ordered passes against all pairs, with ties."""
    import random

    r = random.Random(3)
    cues = spark.createDataFrame([(r.randrange(3), k, r.randrange(12)) for k in range(40)], "u int, cue int, at int")
    refs = spark.createDataFrame([(r.randrange(3), k, r.randrange(12)) for k in range(40)], "u int, ref int, rat int")
    fenced = spans.fenced(cues, ["u"], "at")  # of cues at one place any but one has an empty reach
    last = cues.groupBy("u", "at").agg(F.max("cue").alias("cue"))
    want = last.join(fenced.groupBy("u", "at").agg(F.max(F.coalesce("fence", F.lit(99))).alias("fence")), ["u", "at"]).join(refs, "u").where("rat > at AND rat < fence")
    assert rows(spans.forward_targets(cues, refs, ["u"], "at", "rat", "cue").select("u", "cue", "ref")) == rows(want.select("u", "cue", "ref"))
    pairs = spans.nearest_side(cues.join(refs, "u"), ["u", "cue"], "at", "at", "rat", "rat")
    got = spans.nearest_refs(cues, refs, ["u"], "cue", "at", "ref", "rat", 3)
    assert rows(got.select("u", "cue", "ref", "side", "distance", "rank")) == rows(spans.nearest_k(pairs, ["u", "cue"], "distance", "ref", 3).select("u", "cue", "ref", "side", "distance", "rank"))


def test_ranked(spark):
    df = spark.createDataFrame([(None if k % 5 == 0 else k % 2, (k * 7919) % 101) for k in range(101)], "g int, i int")
    from pyspark.sql import Window

    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("i")))
    assert rows(sampling.ranked(df, ["g"], ["i"], "n")) == rows(want)


def test_nearest_after_and_lists(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "x"), (1, 3, None)], "k int, i int, v string")
    assert rows(spans.nearest_after(df, ["k"], ["i"], "v", "w").select("i", "w")) == [(1, "x"), (2, "x"), (3, None)]
    assert spark.range(1).select(spans.expand_list(F.lit("3, 4 và 5")).alias("x")).first().x == ["3", "4", "5"]


def test_strongest_group_and_precedence(spark):
    e = spark.createDataFrame([("a", "b", "thay_the"), ("a", "b", "bai_bo"), ("a", "b", "dan_chieu"), ("a", "c", "bai_bo")], "head string, tail string, rel string")
    kept = relations.strongest_group(e, ["head", "tail"], "rel", (("sua_doi",), ("thay_the",), ("bai_bo",)))
    assert rows(kept.select("tail", "rel")) == [("b", "dan_chieu"), ("b", "thay_the"), ("c", "bai_bo")]
    new = spark.createDataFrame([("a", "c", "thay_the"), ("a", "c", "bai_bo"), ("x", "y", "huy_bo")], "head string, tail string, rel string")
    assert rows(relations.without_other_group(e, new, ["head", "tail"], "rel").select("tail", "rel")) == [("c", "bai_bo"), ("y", "huy_bo")]


def test_lookups(spark):
    table = spark.createDataFrame([("n1", 1), ("n1", 1), ("n2", 2), ("n2", 3)], "num string, id int")
    refs = spark.createDataFrame([("n1",), ("n2",), ("n3",), (None,)], "num string")
    assert rows(lookup.resolved(refs, table, ["num"], "id")) == [("n1", 1), ("n2", None), ("n3", None), (None, None)]
    versions = spark.createDataFrame([("k", 2000, "a"), ("k", 2005, "b"), ("k", 2005, "c")], "k string, y int, v string")
    asked = spark.createDataFrame([("k", 1999), ("k", 2004), ("k", 2005), ("z", 2005)], "k string, at int")
    assert rows(lookup.as_of(asked, versions, ["k"], "at", "y", "v")) == [("k", 1999, None, None), ("k", 2004, 2000, "a"), ("k", 2005, 2005, "c"), ("z", 2005, None, None)]
    ids = spark.createDataFrame([(1, "dieu_1_dk_1"), (1, "dieu_2"), (1, "dieu_2_dk_1"), (1, "dieu_2_dk_2")], "doc int, key string")
    bare = spark.createDataFrame([(1, "dieu_1"), (1, "dieu_2")], "doc int, ref string")
    assert rows(lookup.prefix_unique(bare, ids, ["doc"], "ref", "key")) == [(1, "dieu_1", "dieu_1_dk_1"), (1, "dieu_2", None)]


def test_graph(spark):
    clauses = spark.createDataFrame([(7, "dieu_1"), (7, "khoan_1_dieu_1"), (7, "diem_a_khoan_1_dieu_1")], "doc long, key string")
    assert rows(graph.containment(clauses, "doc", "key")) == [("7", "dieu_1#7"), ("dieu_1#7", "khoan_1_dieu_1#7"), ("khoan_1_dieu_1#7", "diem_a_khoan_1_dieu_1#7")]
    up = rows(graph.inserted_edges(clauses.where("key LIKE 'diem%'"), "doc", "key"))
    assert [(h, d) for h, _, d in sorted(up, key=lambda r: r[2])] == [("khoan_1_dieu_1#7", 1), ("dieu_1#7", 2), ("7", 3)]
    found = spark.createDataFrame([(1, "dieu_2", "bai_bo", 5, ""), (1, "", "can_cu", 6, None), (1, "dieu_3", "bai_bo", None, "x")], "source_doc long, source_key string, relation string, target_doc long, target_key string")
    assert rows(graph.status_edges(found).select("head", "rel_type", "tail")) == [("1", "bai_bo", "5"), ("1", "can_cu", "6"), ("dieu_2#1", "bai_bo", "5")]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "head string, tail string")
    start = spark.createDataFrame([("a",)], "node string")
    assert rows(graph.closure(edges, start, 5)) == [("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("a", "d", 3)]
    made = spark.createDataFrame([("a", "law1")], "node string, creator string")
    assert rows(graph.propagated(made, edges, spark.createDataFrame([("c",)], "node string"), 3)) == [("b", "law1"), ("d", "law1")]
    typed = edges.withColumn("rel_type", F.when(F.col("tail") == "d", "dan_chieu").otherwise("bao_gom"))
    assert rows(graph.reset(typed, start, ("bao_gom",)).select("tail")) == [("a",), ("b",), ("c",)]
    nodes = spark.createDataFrame([(1, "x", None), (2, None, None)], "id int, a string, b string")
    assert rows(graph.skeletons(nodes, "id").select("id")) == [(2,)] and not graph.repeated_ids(nodes, "id").collect()


def test_authority(spark):
    n = spark.createDataFrame([("45/2021/NĐ-CP",), ("12/2020/TT-BTC",), ("3/2015/QH13",), ("7/2019/QĐ-UBND",), ("88/CV-BTC",), (None,)], "number string")
    got = {r.number: (r.own_type, r.rank) for r in authority.described(n).collect()}
    assert got == {"45/2021/NĐ-CP": ("nghidinh", 100), "12/2020/TT-BTC": ("thongtu", 80), "3/2015/QH13": ("luat", 130), "7/2019/QĐ-UBND": ("quyetdinh", 50), "88/CV-BTC": ("congvan", 80)}
    cases = [
        ("bai_bo", "12/2020/TT-BTC", "45/2021/NĐ-CP", True),  # a lower body does not repeal a higher one's
        ("bai_bo", "45/2021/NĐ-CP", "12/2020/TT-BTC", False),
        ("huong_dan", "45/2021/NĐ-CP", "12/2020/TT-BTC", True),
        ("huong_dan", "12/2020/TT-BTC", "45/2021/NĐ-CP", False),
        ("thay_the", "88/CV-BTC", "12/2020/TT-BTC", True),  # an administrative paper on a normative one
        ("dan_chieu", "7/2019/QĐ-UBND", "3/2015/QH13", False),
        ("bai_bo", "7/2019/QĐ-UBND", "3/2015/QH13", True),
        ("bai_bo", None, "3/2015/QH13", False),
        ("bai_bo", "45/2021/NĐ-CP", None, False),
    ]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "i int, rel string, s string, t string, want boolean").withColumn("kind", F.lit(None).cast("string"))
    assert all(r.dropped == r.want for r in authority.with_policy(df, "rel", "s", "t", "kind").collect())


def test_extraction(spark):
    made = [
        (1, "dieu_1", "Sửa đổi, bổ sung Nghị định số 5/2015/NĐ-CP như sau:"),
        (1, "khoan_1_dieu_1", "Khoản 2 Điều 3 được đọc lại"),
        (1, "dieu_2", "Bãi bỏ Luật số 3/2014/QH13. [1] ghi chú"),
        (1, "dieu_3", None),
        (2, "dieu_1", "  "),
    ]
    clauses = spark.createDataFrame(made, "doc_id long, com_key string, text string")
    source = spark.createDataFrame([(1, "8/2020/NĐ-CP")], "doc_id long, source_number string")
    got = extract.extract_relations(clauses, source)
    assert rows(got.select("com_key", "relation", "key", "number", "inherited")) == [
        ("dieu_1", "sua_doi_bo_sung", "", "5/2015/NĐ-CP", False),
        ("khoan_1_dieu_1", "sua_doi_bo_sung", "khoan_2_dieu_3", "5/2015/NĐ-CP", True),
    ]  # the repeal of a law by a decree is ruled out


def test_metrics(spark):
    df = spark.createDataFrame([("a", True, True), ("a", True, False), ("b", False, True)], "g string, gold boolean, said boolean")
    got = {r.g: (r.tp, r.fp, r.fn, r.precision, r.recall) for r in metrics.scores(df, F.col("gold"), F.col("said"), [[], ["g"]]).collect()}
    assert got == {None: (1, 1, 1, 0.5, 0.5), "a": (1, 0, 1, 1.0, 0.5), "b": (0, 1, 0, 0.0, 0.0)}
    p, lo, hi = spark.range(1).select(*[F.round(c, 3).alias(n) for c, n in zip(metrics.wilson(F.lit(1615), F.lit(1812)), "plh", strict=True)]).first()
    assert (p, lo, hi) == (0.891, 0.876, 0.905)  # the published interval of the rules
    assert spark.range(1).select(metrics.wilson(F.lit(0), F.lit(0))[2].alias("x")).first().x == 0
    x = spark.range(1).select(metrics.mcnemar_chi2(F.lit(10), F.lit(2)).alias("c")).select("c", metrics.chi2_p_value(F.col("c")).alias("p")).first()
    assert math.isclose(x.c, 49 / 12) and math.isclose(x.p, math.erfc(math.sqrt(49 / 24)))
    units = spark.createDataFrame([("u", [("r1", "huong_dan"), ("r1", "huong_dan"), ("r2", "bai_bo")], [("r1", "quy_dinh_chi_tiet"), ("r3", "bai_bo")])], "u string, preds array<struct<ref:string,rel:string>>, golds array<struct<ref:string,rel:string>>")
    assert rows(metrics.greedy_matches(units, ["u"])) == [("u", "r1|huong_dan", "r1|quy_dinh_chi_tiet"), ("u", "r1|huong_dan", None), ("u", "r2|bai_bo", None), ("u", None, "r3|bai_bo")]


def test_sampling(spark):
    cells = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "cell string, w int")
    assert rows(sampling.allocated(cells, F.col("w"), 7, ["cell"]).select("cell", "quota")) == [("a", 4), ("b", 2), ("c", 1)]
    df = spark.createDataFrame([("s", k) for k in range(11)] + [("t", k) for k in range(2)], "g string, i int")
    assert rows(sampling.evenly_spaced(df, ["g"], ["i"], 3)) == [("s", 0), ("s", 10), ("s", 5), ("t", 0), ("t", 1)]
    once = sampling.sample_by_cell(df, ["g"], F.lit(4), 1, "g", "i")
    assert rows(once) == rows(sampling.sample_by_cell(df.repartition(5), ["g"], F.lit(4), 1, "g", "i")) and once.count() == 6
    same = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None), (5, None)], "id int, t string")
    assert {r.id for r in sampling.first_of_text(same, F.coalesce("t", F.lit("")), ["id"]).collect()} == {1, 2, 4}


def test_sources(spark, tmp_path):
    listed = json.dumps([{"com_key": "dieu_1", "com_title": "T"}, {"com_key": "khoan_1_dieu_1"}])
    docs = spark.createDataFrame([(1, listed, None), (2, None, bytearray(gzip.compress(listed.encode()))), (3, None, bytearray(b"broken")), (4, "not json", None)], "doc int, parsed string, packed binary")
    got = rows(sources.clause_rows(docs, "doc", "parsed", "packed").select("doc", "pos", "com_key"))
    assert got == [(1, 0, "dieu_1"), (1, 1, "khoan_1_dieu_1"), (2, 0, "dieu_1"), (2, 1, "khoan_1_dieu_1")]
    (tmp_path / "ids.json").write_text('[1, "2", "x", 999999999624015]')
    assert rows(sources.read_ids(spark, str(tmp_path / "ids.json"))) == [(1,), (2,), (999999999624015,)]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert rows(sources.upserted(old, spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string"), ["id"])) == [(1, "a"), (2, "c"), (3, "d")]
    sources.write_json_lines(old, str(tmp_path / "out"))
    assert rows(sources.read_json_lines(spark, str(tmp_path / "out"), "id int, v string").select("id", "v")) == [(1, "a"), (2, "b")]
    (tmp_path / "laws.csv").write_text("STT,doc_id,so_hieu,loai_van_ban,tieu_de,nam_ban_hanh\r\n1,10,1/2020/QH14,Luật,\"Luật A, B\",2020\r\n")
    laws = sources.read_catalogue(spark, str(tmp_path / "laws.csv"))
    more = spark.createDataFrame([(None, 10, "x", "Luật", "dup", 2020), (None, 11, "2/2021/QH15", "Luật", "Luật C", 2021)], laws.schema)
    assert rows(sources.enriched_catalogue(laws, more).select("STT", "doc_id")) == [(1, 10), (2, 11)]
    assert [r.tieu_de for r in sources.catalogue_titles(laws).collect()] == ["Luật A, B"]


def test_landing_is_idempotent(spark, tmp_path):
    land, schema = str(tmp_path / "land"), "id int, v string"
    table = landing.VersionedTable(spark, str(tmp_path / "table"))
    for v in ("a", "b"):
        spark.createDataFrame([(1, v), (2 if v == "a" else 3, v)], schema).write.mode("append").parquet(land)
        landing.run_landing(landing.read_landing(spark, land, schema), lambda df: df.where("v <> 'z'"), table, ["id"], str(tmp_path / "check"))
    want = [(1, "b"), (2, "a"), (3, "b")]
    assert rows(table.read()) == want and table.batches() == [0, 1]
    table.apply(spark.createDataFrame([(9, "replayed")], schema), 1, ["id"])  # a batch that was applied
    assert rows(table.read()) == want
    done = spark.createDataFrame([(1,)], "id int")
    assert rows(landing.unprocessed(table.read(), done, "id").select("id")) == [(2,), (3,)]


def test_classify(spark):
    docs = spark.createDataFrame([(1, "Luật", "Trung ương", ["Quốc hội"]), (2, "Dự thảo Luật", "Trung ương", []), (3, "Quyết định", "Hà Nội", None), (4, "Thông tư", None, ["Bộ ở Trung ương"]), (5, "Thông tư", " ", []), (6, None, "x", [])], "i int, kind string, place string, units array<string>")
    got = {r.i: r.x for r in docs.select("i", classify.issuer(F.col("kind"), F.col("place"), F.col("units")).alias("x")).collect()}
    assert got == {1: "law", 2: "draft", 3: "local", 4: "central", 5: None, 6: None}
    lists = F.create_map(F.lit("k"), F.array(F.lit(1)))
    one = spark.range(1).select(
        classify.relation_bucket(F.lit("Về hiệu lực, căn cứ"), lists, {"R2": ("k",)}).alias("a"),
        classify.relation_bucket(F.lit("x"), lists, {"R1": ("none",), "R2": ("k",)}).alias("b"),
        classify.year_bucket(F.lit(2021)).alias("c"),
        classify.authority_level(F.lit("UBND tỉnh A"), F.lit(None).cast("string")).alias("d"),
        classify.keep_failed(F.lit("thongtu"), F.lit("Thông tư")).alias("e"),
        classify.keep_failed(F.lit("thongtu"), F.lit("Thông tư số 5")).alias("f"),
        classify.keep_failed(F.lit("vanban"), F.lit("Văn bản đề nghị theo mẫu số 5")).alias("g"),
        classify.display_reference(F.lit("a"), F.lit(None).cast("string"), F.lit("Điều 5"), F.lit("Luật X")).alias("h"),
        classify.marked_text(F.lit("sửa Điều 5 nay"), (F.lit(0), F.lit(3)), (F.lit(4), F.lit(10))).alias("i"),
        classify.ambiguous(F.array(F.lit("bai_bo")), F.lit(3), F.lit(0), F.lit(False)).alias("j"),
        classify.one_json_object(F.lit('<think>{"no":1}</think> so {"a": {"b": 1}} }')).alias("k"),
        classify.unresolved_category(F.lit("luat"), F.lit("Luật A năm 2020")).alias("l"),
        classify.type_from_number(F.lit("3/2020/NQ-HĐND")).alias("m"),
    ).first()
    assert tuple(one) == ("R3", "R2", "Y2", "local", False, True, False, "điểm a Điều 5 Luật X", "[ACT]sửa[/ACT] [REF]Điều 5[/REF] nay", "no_target", '{"a":{"b":1}}', "law_title_date", "Nghị quyết")


def test_terms(spark):
    from weftline.functions.text import corrected_term

    n = spark.createDataFrame([("5/2018/QH13",), ("5/2016/QH13",), ("5/2016/QH14",), ("5/2012/QH12",), ("9/2020/NĐ-CP",), (None,)], "n string")
    assert [r.x for r in n.select(corrected_term(F.col("n")).alias("x")).collect()] == ["5/2018/QH14", "5/2016/QH13", "5/2016/QH14", "5/2012/QH13", "9/2020/NĐ-CP", None]


def test_retry():
    from weftline.operators.scan import with_retry

    calls, waits = [], []

    def write():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")

    assert with_retry(write, 5, 1.0, 2.0, waits.append) == 3 and waits == [1.0, 2.0]
    calls.clear()
    with pytest.raises(OSError):
        with_retry(write, 2, sleep=waits.append)


def test_writer_on_awkward_edges(spark):
    from weftline.operators import writer

    edges = spark.createDataFrame([(None, "a"), ("a", None), ("a", "b"), ("a", "b"), ("a", "z")], "head string, tail string")
    nodes = spark.createDataFrame([("a",), ("b",), ("b",)], "node string")
    got = {(r.head, r.tail): (r.status, r.reason) for r in writer.written(edges, nodes, "strict-no-heal").collect()}
    assert got == {(None, "a"): ("deferred", "missing_source"), ("a", None): ("deferred", "missing_target"), ("a", "b"): ("written", None), ("a", "z"): ("deferred", "missing_target")}
    assert writer.written(edges, nodes, "legacy").count() == 5 and not writer.written(edges.limit(0), nodes, "legacy").collect()
    with pytest.raises(ValueError):
        writer.written(edges, nodes, "other")
    left, rest = writer.without_documents(nodes.selectExpr("concat('x#', node) AS node"), edges.selectExpr("concat('x#', head) AS head", "tail"), spark.createDataFrame([("a",), (None,)], "doc_id string"))
    assert {r.node for r in left.collect()} == {"x#b"} and {r["tail"] for r in rest.collect()} == {"a"} - {"a"}
    assert writer.without_containment(spark.createDataFrame([("a", "bao_gom"), ("b", "bai_bo")], "head string, rel_type string")).count() == 1


def shuffled_records(spark):
    """Records that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (stages.apply(k) for k in range(stages.size()))}


def test_like_titles_make_no_square_of_pairs(spark):
    common = [f"w{k}" for k in range(10)]
    like = [(f"like{k}", [*common, f"x{k}", f"y{k}"]) for k in range(1000)]
    others = [("p1", ["a", "b", "c", "d", "e"]), ("p2", ["a", "b", "c", "d", "f"]), ("q1", ["g", "h", "i"]), ("q2", ["i", "h", "g"]), ("q3", ["g", "h", "i"]), ("lone", ["z"])]
    edge = [("edge", [*(f"x{k}" for k in range(3, 9)), "m1", "m2"]), ("edge2", [*(f"x{k}" for k in range(3, 9)), "m3", "m4"])]
    a = spark.createDataFrame(like + others + edge, "id string, toks array<string>")
    b = a.select(F.col("id").alias("found"), F.col("toks").alias("found_toks"))
    before = shuffled_records(spark)
    got = rows(lookup.fuzzy_unique(a, b, "toks", "found_toks", "id", "found", 0.6, proper=True))
    assert got == [("edge", "edge2"), ("edge2", "edge"), ("p1", "p2"), ("p2", "p1")]
    written = sum(n for k, n in shuffled_records(spark).items() if k not in before)
    assert 0 < written < 200_000, written


def test_a_title_is_found_among_many_that_share_its_token(spark):
    """The only fitting title may be in any part of a token's titles."""
    many = [(f"t{k:04}", ["s", f"a{k}", f"b{k}", f"c{k}"]) for k in range(2500)]
    titles = spark.createDataFrame(many, "found string, found_toks array<string>")
    refs = spark.createDataFrame([(k, ["s", f"a{k}"]) for k in range(0, 2500, 250)] + [(-1, ["s", "a1", "b1", "c1"])], "id int, toks array<string>")
    got = rows(lookup.fuzzy_unique(refs, titles, "toks", "found_toks", "id", "found", 0.5))
    assert got == sorted([(k, f"t{k:04}") for k in range(0, 2500, 250)] + [(-1, "t0001")], key=repr)
    every = rows(lookup.fuzzy_unique(refs.limit(0), titles, "toks", "found_toks", "id", "found", 0.5))
    assert every == []


def test_equal_clauses_come_to_one_partition(spark):
    """So the rules run once for a text that many documents have; each document keeps its matches."""
    from weftline.functions import clause_text

    said = ["Bãi bỏ khoản 2 Điều 5 Nghị định số 15/2019/NĐ-CP.", "Bãi bỏ khoản 3 Điều 5 Nghị định số 16/2019/NĐ-CP.", "Không có gì."]
    clauses = spark.createDataFrame([(d, "dieu_1", said[d % 3]) for d in range(300)], "doc_id long, com_key string, text string")
    ready = extract.cleaned(clauses).withColumn("parent_text", F.lit(None).cast("string"))
    assert ready.select("text", F.spark_partition_id()).distinct().count() == 3
    got = rows(extract.matched(ready).select("doc_id", "com_key", "relation", "key", "number"))
    assert got == sorted(((d, "dieu_1", "bai_bo", f"khoan_{d % 3 + 2}_dieu_5", f"{d % 3 + 15}/2019/NĐ-CP") for d in range(300) if d % 3 < 2), key=repr)
    assert clause_text.cues(said[0]) == clause_text.cues(said[1])


def test_rows_of_one_source_number_stay_apart(spark):
    """The policy sends no row to a task by its numbers, though all documents have the same one."""
    df = spark.range(4000, numPartitions=4).selectExpr("'bai_bo' AS rel", "'20/2021/NĐ-CP' AS s", "if(id % 2 = 0, '5/2019/NĐ-CP', '3/2014/QH13') AS t", "CAST(null AS string) AS kind")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = authority.with_policy(df, "rel", "s", "t", "kind").withColumn("part", F.spark_partition_id())
        assert rows(judged.groupBy("t", "dropped").agg(F.count("*"), F.count_distinct("part"))) == [("3/2014/QH13", True, 2000, 4), ("5/2019/NĐ-CP", False, 2000, 4)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clean_texts_are_left_as_they_are(spark):
    """The signs that call for cleaning are all that cleaning changes."""
    from weftline.functions.text import clean_markup, drop_reasons

    clean = ["a b", "\u00a0a", "a\u2028b", "a./b", "(a)", "Lý lẽ. b"]
    said = [*clean, " a", "a ", "a  b", "a\tb", "a\nb", "a\x0bb", "a\r\nb", "a \u0085", "a \u2028", "a[1] b", "[TABLE] a", "a <TABLE>x</table> b", "a ./. b", "Lý do b. c", "a. Lý do bãi bỏ", " ", ""]
    df = spark.createDataFrame([(k, "dieu_1", t) for k, t in enumerate(said)], "doc_id long, com_key string, text string")
    want = df.withColumn("text", drop_reasons(clean_markup(F.col("text")))).where("text <> ''")
    assert rows(extract.cleaned(df)) == rows(want)
    left = df.where(~extract.unclean(F.col("text"))).collect()
    assert {r.text for r in left} == {*clean, ""}
