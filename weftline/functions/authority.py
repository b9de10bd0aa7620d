"""Who issued a document, as far as its number tells, and which relations its rank allows; all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.fixed import LOWER_TO_UPPER_RESTRICTED, UPPER_TO_LOWER_RESTRICTED
from weftline.functions.text import fold_accents
from weftline.sources.scratch import stored

# --- fixed values ---

#: Code in a number, folded and in capitals -> document type.
TYPE_CODES = {
    "NQLT": "nghiquyetlientich", "TTLT": "thongtulientich", "ND": "nghidinh", "TT": "thongtu", "NQ": "nghiquyet", "QD": "quyetdinh", "KH": "kehoach", "CT": "chithi",
    "CV": "congvan", "UBTVQH": "phaplenh", "QH": "luat",
}

#: Code of an issuing body -> its rank. QH and UBTVQH may carry the number of the assembly.
BODY_CODES = {
    "QH": 130, "UBTVQH": 120, "CTN": 110, "CP": 100, "TTG": 90, "HDTP": 85, "TANDTC": 80, "VKSNDTC": 80, "KTNN": 80, "NHNN": 80, "TTCP": 80, "HDND": 60, "UBND": 50, "UB": 50,
    "BCA": 80, "BCT": 80, "BGDDT": 80, "BGTVT": 80, "BKHCN": 80, "BKHDT": 80, "BLDTBXH": 80, "BNG": 80, "BNNPTNT": 80, "BNV": 80, "BQP": 80, "BTC": 80, "BTNMT": 80,
    "BTP": 80, "BTTTT": 80, "BVHTTDL": 80, "BXD": 80, "BYT": 80, "UBDT": 80, "VPCP": 80,
}

#: Names of issuing bodies, folded, the more special ones first -> rank.
BODY_NAMES = (
    ("HIEN PHAP", 140), ("QUOC HOI", 130), ("CHU TICH NUOC", 110), ("THU TUONG", 90), ("CHINH PHU", 100), ("HOI DONG THAM PHAN", 85), ("TONG KIEM TOAN", 80), ("TAND CAP CAO", 70),
    ("VKSND CAP CAO", 70), ("TAND TINH", 60), ("VKSND TINH", 60), ("TAND HUYEN", 30), ("VKSND HUYEN", 30),
)

#: Rank of a type, where the issuing body is not known.
TYPE_RANKS = {
    "hienphap": 140, "luat": 130, "boluat": 130, "phaplenh": 120, "lenh": 110, "nghidinh": 100, "nghiquyet": 100, "nghiquyetlientich": 100, "quyetdinh": 90,
    "thongtu": 80, "thongtulientich": 70,
}
ADMINISTRATIVE = ("congvan", "chithi", "congdien", "kehoach", "huongdan", "vanban")
ALWAYS_NORMATIVE = ("hienphap", "luat", "boluat", "phaplenh", "lenh")
STRONG_ACTIONS = ("sua_doi_bo_sung", "sua_doi", "bo_sung", "thay_the", "bai_bo", "huy_bo", "dinh_chi", "ngung_hieu_luc", "dinh_chinh", "keo_dai_hieu_luc")
GUIDANCE = ("quy_dinh_chi_tiet", "huong_dan")
RESOLUTIONS = ("nghiquyet", "nghiquyetlientich")
LOCAL_MARKS = "UBND|HĐND|QĐ-UB|QĐ-HĐ"
LOCAL_TO_CENTRAL_RESTRICTED = (
    "sua_doi_bo_sung", "thay_the", "bai_bo", "huy_bo", "quy_dinh_chi_tiet", "huong_dan", "ngung_hieu_luc", "dinh_chi", "dinh_chinh", "keo_dai_hieu_luc",
)

#: What is known of numbers is broadcast up to so many bytes, else both sides are shuffled.
BROADCAST_BYTES = 64 << 20

# --- end of fixed values ---


def policy_text(number: Column) -> Column:
    return F.regexp_replace(F.upper(fold_accents(F.coalesce(number, F.lit("")))), r"\s+", " ")


def _codes(text: Column) -> Column:
    """The codes of a number: its parts between / and -, without the number of the assembly."""
    return F.transform(F.split(text, "[/-]"), lambda part: F.regexp_replace(F.trim(part), r"^(QH|UBTVQH)\d+$", "$1"))


def _mapped(codes: Column, known: dict) -> Column:
    """The values of those codes that are known, in order."""
    pairs = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.filter(F.transform(codes, lambda c: F.try_element_at(pairs, c)), lambda v: v.isNotNull())


def _named(text: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in reversed(BODY_NAMES):
        out = F.when(text.contains(name), rank).otherwise(out)
    return out


def type_of(number: Column) -> Column:
    """The type that the first known code names. A law's number needs its year: 'QH' alone may be any act of the assembly."""
    text = policy_text(number)
    first = F.get(_mapped(_codes(text), TYPE_CODES), F.lit(0))
    law = text.rlike(r"^\s*\d+/\d{4}/QH")
    return F.when(text.contains("HIEN PHAP"), "hienphap").when((first == "luat") & ~law, F.lit(None)).otherwise(first)


def rank_of(number: Column) -> Column:
    """The rank of the highest body that the number names, by code, else by name. A ministry that is not in the list is known by its 'B' after
    a type's code."""
    text = policy_text(number)
    codes = _codes(text)
    last = F.element_at(codes, -1)
    ministry = F.when(last.rlike("^B[A-Z]{1,7}$") & (F.size(_mapped(codes, TYPE_CODES)) > 0), 80)
    return F.coalesce(F.array_max(_mapped(codes, BODY_CODES)), _named(text), ministry)


def family_of(number: Column) -> Column:
    """The body's code, where it is the government, its head, a ministry or the state bank."""
    text = policy_text(number)
    family = F.filter(_codes(text), lambda c: c.isin("TTG", "CP", "NHNN") | c.rlike("^B[A-Z]{1,7}$"))
    return F.when(text.contains("THU TUONG"), "TTG").when(text.contains("CHINH PHU"), "CP").otherwise(F.get(family, F.lit(0)))


def type_rank(kind: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in TYPE_RANKS.items():
        out = F.when(kind == name, rank).otherwise(out)
    return out


def year_of(number: Column) -> Column:
    return F.regexp_extract(number, r"[/-]((?:19|20)\d{2})(?:[/-]|$)", 1).try_cast("int")


def is_local(number: Column) -> Column:
    return F.coalesce(number.rlike(LOCAL_MARKS), F.lit(False))


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def described(numbers: DataFrame) -> DataFrame:
    """number, own_type, rank, year, family, local and said (not blank) of distinct numbers (column number)."""
    n = F.col("number")
    return (
        numbers.select("number")
        .where("number IS NOT NULL")
        .distinct()
        .select("number", type_of(n).alias("own_type"), rank_of(n).alias("rank"), year_of(n).alias("year"), family_of(n).alias("family"), is_local(n).alias("local"), n.rlike(r"\S").alias("said"))
    )


def with_info(df: DataFrame, info: DataFrame, number: str, kind: str | None, prefix: str) -> DataFrame:
    """df with what described() tells of a number, under names with prefix: type (else kind's), rank, type_rank, normative, family, local, said."""
    p = lambda n: f"{prefix}_{n}"
    named = info.select(F.col("number").alias(p("number")), *[F.col(c).alias(p(c)) for c in ("own_type", "rank", "year", "family", "local", "said")])
    joined = df.join(named, F.col(number) == F.col(p("number")), "left")
    typed = joined.withColumn(p("type"), F.col(p("own_type")) if kind is None else F.coalesce(p("own_type"), kind))
    kind_ = F.col(p("type"))
    normative = _yes(kind_.isin(*ALWAYS_NORMATIVE)) | (_yes(~kind_.isin(*ADMINISTRATIVE)) & F.col(p("year")).isNotNull())
    return typed.withColumns({p("type_rank"): type_rank(kind_), p("normative"): normative}).drop(p("number"), p("own_type"), p("year"))


def way(s: str, t: str) -> Column:
    """source_higher or source_lower, of what with_info() gave under the prefixes s and t: by rank of the bodies, then of the types; null
    if neither tells."""
    sr, tr, st, tt = F.col(f"{s}_rank"), F.col(f"{t}_rank"), F.col(f"{s}_type_rank"), F.col(f"{t}_type_rank")
    s_type, t_type = F.col(f"{s}_type"), F.col(f"{t}_type")
    by_body = F.when(sr > tr, "source_higher").when(sr < tr, "source_lower")
    by_type = F.when(st > tt, "source_higher").when(st < tt, "source_lower")
    across = F.when(sr.isNotNull() & st.isNull() & tr.isNull() & t_type.isin(*ALWAYS_NORMATIVE) & (sr < tt), "source_lower")
    by_kind = F.when(s_type.isin(*RESOLUTIONS) & (t_type == "quyetdinh"), "source_higher").when((s_type == "quyetdinh") & t_type.isin(*RESOLUTIONS), "source_lower")
    return F.coalesce(by_body, by_type, across, by_kind)


def _small(df: DataFrame, size: Column) -> DataFrame:
    """A stored table, broadcast where it is used if it is not too large for that."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def with_policy(df: DataFrame, relation: str, source: str, target: str, target_type: str, sources: DataFrame | None = None, targets: DataFrame | None = None) -> DataFrame:
    """df with dropped: whether rank and kind of the two documents rule the relation out. Without a source number, or anything known of
    the target, nothing is ruled out. sources (column of source numbers) and targets (relation, target and type) have all that df has, if that is
    known without df.

    What hangs on a source, or on a relation and target, is worked out once for each and stored. Small tables are broadcast, so that rows of a number that
    very many have stay where they are; and the expression that is left for each row is so short that the JVM compiles it."""
    own, c = list(df.columns), F.col
    heads = (df if sources is None else sources).select(c(source).alias("number")).distinct()
    cases = (df if targets is None else targets).select(c(relation).alias("_rel"), c(target).alias("_target"), c(target_type).alias("_kind")).distinct()
    cases = stored(cases, "targets")
    info = stored(described(heads.unionByName(cases.select(c("_target").alias("number")))), "numbers")
    info = _small(info, F.octet_length("number") + 128)

    heads = with_info(heads.where("number IS NOT NULL"), info, "number", None, "_s").withColumn("_s_adm", _yes(c("_s_type").isin(*ADMINISTRATIVE)))
    heads = _small(stored(heads.withColumnRenamed("number", "_source"), "sources"), F.octet_length("_source") + 128)
    rel = c("_rel")
    cases = with_info(cases, info, "_target", "_kind", "_t")
    cases = cases.withColumns(
        {
            "_strong": rel.isin(*STRONG_ACTIONS),
            "_guides": rel.isin(*GUIDANCE),
            "_ways": F.concat_ws(" ", F.when(rel.isin(*UPPER_TO_LOWER_RESTRICTED), "source_higher"), F.when(rel.isin(*LOWER_TO_UPPER_RESTRICTED), "source_lower")),
            "_upward": ~_yes(c("_t_local")) & c("_target").isNotNull() & rel.isin(*LOCAL_TO_CENTRAL_RESTRICTED),
            "_t_adm": _yes(c("_t_type").isin(*ADMINISTRATIVE)),
            "_t_given": c("_target").isNotNull() | c("_kind").isNotNull(),
        }
    ).drop("_t_local", "_t_said")
    cases = _small(stored(cases, "cases"), F.coalesce(F.octet_length("_target"), F.lit(0)) + 256)

    same = c(relation).eqNullSafe(c("_rel")) & c(target).eqNullSafe(c("_target")) & c(target_type).eqNullSafe(c("_kind"))
    d = df.join(heads, c(source) == c("_source"), "left").join(cases, same, "left")
    for name in ("_s_adm", "_s_normative", "_s_local", "_s_said"):
        d = d.withColumn(name, _yes(c(name)))
    mixed = c("_strong") & ((c("_s_adm") & c("_t_normative")) | (c("_s_normative") & c("_t_adm")))
    same_body = c("_strong") & _yes(c("_t_type") == "quyetdinh") & _yes(c("_s_family") == c("_t_family"))
    same_rank = c("_strong") & _yes(c("_s_type").isin(*RESOLUTIONS)) & _yes(c("_t_type") == "nghidinh") & _yes(c("_s_rank") == c("_t_rank"))
    level = lambda p: F.coalesce(c(f"{p}_rank"), c(f"{p}_type_rank"))
    guide = c("_guides") & ((c("_s_normative") != c("_t_normative")) | _yes(level("_s") == level("_t")))
    ranked = _yes(F.contains(c("_ways"), way("_s", "_t")))
    drops = F.when(mixed, True).when(same_body | same_rank, False).when(guide, True).otherwise(ranked)
    return d.withColumn("dropped", _yes(c("_s_said") & c("_t_given") & (drops | (c("_s_local") & c("_upward"))))).select(*own, "dropped")
