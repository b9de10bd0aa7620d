from __future__ import annotations

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions import clause_text, match_filters
from weftline.functions import text as X
from weftline.functions.clause_text import cues, longest_first, matches, mentions, range_values, sentences


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: X.clean_markup(F.lit("a [TABLE]x\ny[\\TABLE] b <table a=1>\n</TABLE>c ./. tail\nmore")), "a  b c"),
        (lambda: X.clean_markup(F.lit("body [1] note one [2] note two")), "body"),
        (lambda: X.drop_reasons(F.lit("Lý do bãi bỏ: cũ. Còn \t lại\n\n  dòng  hai ")), "Còn lại\ndòng hai"),
        (lambda: X.drop_quoted(F.lit("giữ “bỏ đi” lại\n'và' cả dòng này")), "giữ lại\ncả dòng này"),
        (lambda: X.fold_accents(F.lit("Điều ước Quốc tế ĐẶC")), "Dieu uoc Quoc te DAC"),
        (lambda: X.number_key(F.lit(" số 45 / 2021 / nđ–cp ")), "45/2021/ND-CP"),
        (lambda: X.number_variants(F.lit("12/NĐ"))[0], "12/NĐ"),
        (lambda: X.graph_parent_key(F.lit("diem_a_khoan_2_dieu_14")), "khoan_2_dieu_14"),
        (lambda: X.graph_parent_key(F.lit("dieu_14")), None),
        (lambda: X.extract_parent_candidate(F.lit("khoan_2_dieu_1_1_dk_1")), "dieu_1_1_dk_1"),
        (lambda: X.graph_parent_key(F.lit("khoan_2_dieu_1_1_dk_1")), "dieu_1_1_dk_1"),
        (lambda: X.readable_key(F.lit("diem_đ_khoan_1_dieu_42a")), "Điểm đ Khoản 1 Điều 42a"),
        (lambda: X.readable_key(F.lit("khoan_1a_dieu_2")), "Điều 2"),
        (lambda: X.compose_key(F.lit("a"), F.lit(None).cast("string"), F.lit("3")), "diem_a_dieu_3"),
        (lambda: X.key_value(F.lit(" Đ.1 "), "diem"), "đ1"),
        (lambda: X.key_value(F.lit("5Đ"), "dieu"), "5d"),
        (lambda: X.point_range(F.lit("c"), F.lit("e")), ["c", "d", "đ", "e"]),
        (lambda: X.point_range(F.lit("e"), F.lit("c")), []),
        (lambda: X.valid_shape(F.array(F.lit("dieu"), F.lit("diem"))), True),
        (lambda: X.valid_shape(F.array(F.lit("khoan"))), False),
        (lambda: X.longest_quoted(F.lit('sửa "ngắn" và “dài hơn nhiều”')), "dài hơn nhiều"),
        (lambda: X.token_jaccard(F.lit("Luật đất đai"), F.lit("LUAT DAT")), 2 / 3),
        (lambda: X.is_consolidated(F.lit("05/vbhn-BTC")), True),
        (lambda: X.before_basis(F.lit("Tiêu đề\ncăn  cứ Luật")), "Tiêu đề\n"),
        (lambda: X.basis_lines(F.lit("Căn cứ A\nB\nCăn cứ C"))["basis"], "Căn cứ A\nCăn cứ C"),
        (lambda: X.cut_after_effect(F.lit("X hết hiệu lực kể từ ngày Luật này có hiệu lực thi hành, trừ Y"), ["Nghị định", "Luật"]), "X hết hiệu lực kể từ ngày Luật này có hiệu lực thi hành"),
        (lambda: X.date_matches(F.lit(2020), F.lit(3), F.lit(None).cast("int"), F.lit("2020-03-09")), True),
        (lambda: X.date_matches(F.lit(2020), F.lit(4), F.lit(None).cast("int"), F.lit("2020-03-09")), False),
        (lambda: X.nfc(F.lit("é")), "é"),
        (lambda: X.unidecode(F.lit("Đường ½")), "Duong 12"),
        (lambda: X.sequence_ratio(F.lit("abcd"), F.lit("bcde")), 0.75),
    ],
)
def test_text_functions(spark, column, want):
    assert value(spark, column()) == want


LAW = "Sửa đổi, bổ sung điểm a và b khoản 2 Điều 14 Nghị định số 45/2021/NĐ-CP ngày 31 tháng 3 năm 2021 như sau:"

#: text, own key, relations that must be found, relations that must not.
CASES = [
    (LAW, "", {("sua_doi_bo_sung", "diem_a_khoan_2_dieu_14", "45/2021/NĐ-CP"), ("sua_doi_bo_sung", "diem_b_khoan_2_dieu_14", "45/2021/NĐ-CP")}, {"bo_sung", "sua_doi"}),
    ("Bãi bỏ khoản 3, 4 và 5 Điều 7, Điều 9 của Thông tư 12/2019/TT-BTC; theo quy định tại khoản 1 Điều này.", "khoan_2_dieu_9",
     {("bai_bo", f"khoan_{k}_dieu_7", "12/2019/TT-BTC") for k in (3, 4, 5)} | {("bai_bo", "dieu_9", "12/2019/TT-BTC"), ("dan_chieu", "khoan_1_dieu_9", None)}, {"thay_the"}),
    ("Nghị định số 10/2010/NĐ-CP hết hiệu lực kể từ ngày Nghị định này có hiệu lực thi hành.", "", {("thay_the", "", "10/2010/NĐ-CP")}, {"bai_bo"}),
    ("Quyết định số 7/2011/QĐ-TTg hết hiệu lực thi hành.", "", {("bai_bo", "", "7/2011/QĐ-TTg")}, {"thay_the"}),
    ("Người nộp bổ sung hồ sơ theo Điều 5 Luật này.", "", {("dan_chieu", "dieu_5", None)}, {"sua_doi_bo_sung"}),
    ("Bãi bỏ Thông tư số 3/2015/TT-BTC (được sửa đổi theo Thông tư số 9/2016/TT-BTC).", "", {("bai_bo", "", "3/2015/TT-BTC")}, {"sua_doi_bo_sung"}),
    ("Thay thế từ khoản 1 đến khoản 3 Điều 8 Nghị định số 2/2012/NĐ-CP.", "", {("thay_the", f"khoan_{k}_dieu_8", "2/2012/NĐ-CP") for k in (1, 2, 3)}, {"bai_bo"}),
    ("Quy định chi tiết Luật Đất đai.", "", {("quy_dinh_chi_tiet", "", None)}, {"huong_dan"}),
    ("Kéo dài thời gian công tác theo Điều 3.", "", {("dan_chieu", "dieu_3", None)}, {"keo_dai_hieu_luc"}),
    ("Bổ sung dự án Luật Đất đai vào chương trình lập pháp năm 2020.", "", set(), {"sua_doi_bo_sung"}),
    ("Bãi bỏ quy định chuyển tiếp áp dụng trước thời điểm Luật số 1/2015/QH13 có hiệu lực thi hành.", "", set(), {"bai_bo"}),
    ("Bãi bỏ Nghị quyết số 5/2010/NQ-HĐND về việc kéo dài Nghị quyết số 4/2009/NQ-HĐND.", "", {("bai_bo", "", "5/2010/NQ-HĐND")}, {"keo_dai_hieu_luc"}),
    ("Bãi bỏ:\n1. Thông tư số 3/2015/TT-BTC\n", "", set(), {"thay_the"}),
    ("Sửa đổi khoản 1 Điều 2 Nghị định số 8/2010/NĐ-CP đã được sửa đổi tại Nghị định số 9/2012/NĐ-CP.", "", {("sua_doi_bo_sung", "khoan_1_dieu_2", "8/2010/NĐ-CP")}, {"bai_bo"}),
    ("Thay thế Phụ lục ban hành kèm theo Nghị định số 8/2010/NĐ-CP.", "", {("sua_doi_bo_sung", "", "8/2010/NĐ-CP")}, {"thay_the"}),
    ("Theo quy định của Luật này, Luật Nhà ở và quy định khác.", "", {("dan_chieu", "", None)}, {"can_cu"}),
    ("Không có gì ở đây.", "", set(), {"dan_chieu"}),
    ("", "", set(), set()),
]


@pytest.mark.parametrize(("text", "key", "wanted", "forbidden"), CASES)
def test_clause_relations(text, key, wanted, forbidden):
    found = {(c.relation, m.key, m.number) for c, m in matches(text, key)}
    assert found == wanted, [(c.text, m) for c, m in matches(text, key)]
    assert not {r for r, _, _ in found} & forbidden


def test_titles_and_ranges():
    m = mentions("theo Luật Doanh nghiệp năm 2020 và Bộ luật Dân sự")
    assert [(x.doc_type, x.title, x.date) for x in m] == [("luat", "Luật Doanh nghiệp", "2020"), ("boluat", "Bộ luật Dân sự", None)]
    assert range_values("diem", "đ", "g") == ["đ", "e", "g"] and range_values("khoan", "3", "2") == []
    assert [c.reason for c in cues("tạm đình chỉ hiệu lực giấy phép")] == ["non_legal_dinh_chi"]
    assert sentences("a 1.5 b. c\n d;") == [(0, 7), (9, 10), (12, 13)]


class Span:
    def __init__(self, start, stop):
        self.start, self.stop = start, stop


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 8)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_longest_first(spans):
    every = [Span(a, a + n) for a, n in spans]
    kept = longest_first(every)
    assert all(x.stop <= y.start for x, y in zip(kept, kept[1:], strict=False))
    for s in every:  # whatever is left out meets one that is at least as long
        assert s in kept or any(s.start < k.stop and k.start < s.stop and k.stop - k.start >= s.stop - s.start for k in kept)


@given(st.text(alphabet="Điềuđkhoảnm 12,.;:()Luậtnày\nvàtheoBãi bỏ", max_size=80))
@settings(max_examples=200, deadline=None)
def test_any_text_has_spans_inside(text):
    assert all(0 <= m.start < m.stop <= len(text) for m in mentions(text, "khoan_1_dieu_2"))
    assert all(0 <= c.start < c.stop <= len(text) for c in cues(text))


#: text, (relation, key, number) of its targets: lists below a heading, inserted labels, brackets, continued application, words of a name.
TARGETS = [
    (
        "Điều 1. Hủy bỏ hiệu lực các Quyết định vì không còn phù hợp với Nghị định số 35/2001/NĐ-CP ngày 09/7/2001 và Thông tư 53/2001/TT-BTC.\r\n- Quyết định số 1754/2000/QĐ-UB ngày 21/12/2000;\r\n- Quyết định số 101/2001/QĐ-UB.",
        {("huy_bo", "", "1754/2000/QĐ-UB"), ("huy_bo", "", "101/2001/QĐ-UB")},
    ),
    ("Bổ sung điểm d vào sau điểm c khoản 1 Điều 34 của Nghị định số 5/2023/NĐ-CP như sau:", {("sua_doi_bo_sung", "diem_d_khoan_1_dieu_34", "5/2023/NĐ-CP")}),
    ("Bổ sung điểm e1 và điểm e2 vào sau điểm e khoản 2 Điều 12 như sau:", {("sua_doi_bo_sung", "diem_e1_khoan_2_dieu_12", None), ("sua_doi_bo_sung", "diem_e2_khoan_2_dieu_12", None)}),
    (
        "Thông tư này quy định chi tiết Nghị định số 105/2025/NĐ-CP, bao gồm:\n1. Tiêu chuẩn (khoản 2 Điều 10);\n2. Tổ chức (khoản 3 Điều 18).",
        {("quy_dinh_chi_tiet", "khoan_2_dieu_10", "105/2025/NĐ-CP"), ("quy_dinh_chi_tiet", "khoan_3_dieu_18", "105/2025/NĐ-CP")},
    ),
    ("Hợp đồng đã ký thì tiếp tục thực hiện theo Nghị định số 12/2019/NĐ-CP.", {("dan_chieu", "", "12/2019/NĐ-CP")}),
    ("Sửa đổi khoản 1 Điều 3 Nghị định số 1/2019/NĐ-CP (thay thế Nghị định số 2/2009/NĐ-CP).", {("sua_doi_bo_sung", "khoan_1_dieu_3", "1/2019/NĐ-CP"), ("thay_the", "", "2/2009/NĐ-CP")}),
]


@pytest.mark.parametrize(("text", "wanted"), TARGETS)
def test_targets(text, wanted):
    assert {(c.relation, m.key, m.number) for c, m in matches(text)} == wanted


def test_offsets():
    from weftline.functions.offsets import raw_offsets, raw_span

    raw, clean = "Điều  1.\t<b>Bãi bỏ</b>\n\nkhoản 2", "Điều 1. Bãi bỏ khoản 2"
    to = raw_offsets(raw, clean)
    for word in ("Điều", "Bãi", "khoản 2"):
        a, b = raw_span(to, clean.index(word), clean.index(word) + len(word))
        assert raw[a:b] == word
    assert raw_offsets("", "x") == [0, 0] and raw_offsets("ab", "") == [2] and raw_span(to, 3, 3) == (3, 3)


def test_phrases():
    from weftline.functions.phrases import Words, phrases

    w = Words("Sửa đổi, bổ sung Điều 1 của Luật; theo Luật này")
    assert w.first(0, 20, phrases(("của luật", "của"))) == (7, 9)
    assert w.follows(0, 20, phrases(("sửa đổi",)), phrases(("của",))) and not w.follows(8, 20, phrases(("của",)))
    assert w.ends_with(7, phrases(("điều 1",))) and w.starts_with(2, phrases(("bổ sung",)), frozenset({","}))


def test_numbers_and_bodies(spark):
    from weftline.functions import authority as A

    cases = {"15/2020/NĐ-CP": ("nghidinh", 100), "45/2019/QH14": ("luat", 130), "5/2020/UBTVQH14": ("phaplenh", 120), "12/2015/TTLT-BTC-BCA": ("thongtulientich", 80), "7/2021/QĐ-UBND": ("quyetdinh", 50), "3/QĐ-TTg": ("quyetdinh", 90), "9/2020/NQ-HĐND": ("nghiquyet", 60), "4/2020/TT-BXYZ": ("thongtu", 80), "x": (None, None)}
    rows = spark.createDataFrame([(k,) for k in cases], "number string").select("number", A.type_of(F.col("number")).alias("t"), A.rank_of(F.col("number")).alias("r")).collect()
    assert {x.number: (x.t, x.r) for x in rows} == cases


def test_texts_that_differ_in_digits_only_are_judged_once(monkeypatch):
    """Cues, filters and scopes are found once; values, numbers, dates and titles are each text's own."""
    said = [
        "Bãi bỏ khoản {} Điều {} Nghị định số {}/2019/NĐ-CP.",
        "Thực hiện theo quy định tại khoản {}, {} và {}a Điều 7 Thông tư số 8/2019/TT-BTC.",
        "Bãi bỏ từ khoản {} đến khoản {} Điều {} Luật Đất đai năm 2013.",
        "Sửa đổi, bổ sung Điều này; bãi bỏ Điều {} và {} Nghị định số {}/2020/NĐ-CP (được sửa đổi theo Nghị định số 1/2019/NĐ-CP).",
        "Sửa đổi, bổ sung Nghị định số {}/2019/NĐ-CP như sau: bãi bỏ, sửa đổi khoản 1 Điều 2 Nghị định số {}/2019/NĐ-CP, Nghị định số {}/2019/NĐ-CP.",
        "Kéo dài hiệu lực Nghị quyết số {}/2019/QH14, sửa đổi, bổ sung một số điều của Nghị quyết số {}/2019/QH14 và Nghị quyết số {}/2019/QH14",
    ]
    texts = [s.format(*v) for s in said for v in itertools.product("135", repeat=3)]
    for text in texts:
        plain = clause_text.masked(text)
        refs = list(dict.fromkeys(clause_text._mentions(plain, "khoan_2_dieu_4")))
        assert clause_text.matches(text, "khoan_2_dieu_4") == clause_text._judged(plain, clause_text._reached(plain, refs))
    tried = []
    monkeypatch.setattr(match_filters, "filtered", lambda text, cue, got: tried.append(text) or got)
    got = [[(m.key, m.number) for _, m in clause_text.matches(f"Bãi bỏ điểm b khoản {k} Điều 5 Nghị định số {k + 1}/2018/NĐ-CP.")] for k in range(1, 9)]
    assert got == [[(f"diem_b_khoan_{k}_dieu_5", f"{k + 1}/2018/NĐ-CP")] for k in range(1, 9)] and len(tried) == 1
