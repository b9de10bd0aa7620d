"""Classification of documents and mentions by column: kind of issuer, sampling buckets, what to keep, what is ambiguous."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.text import fold_accents

# --- fixed values ---

YEAR_BUCKETS = (("Y1", 2024, 2026), ("Y2", 2020, 2023), ("Y3", 2015, 2019))
LOCAL_WORDS = ("tỉnh ", "thành phố ", "hđnd", "ubnd", "ủy ban nhân dân", "hội đồng nhân dân")
BUCKET_TITLE_WORDS = {
    "R1": ("sửa đổi", "bổ sung", "bãi bỏ", "hủy bỏ", "thay thế"),
    "R2": ("dẫn chiếu", "căn cứ", "quy định chi tiết", "hướng dẫn"),
    "R3": ("hiệu lực", "đình chỉ", "đính chính", "hợp nhất", "kéo dài", "tạm ngưng"),
}
#: The order in which buckets are tried.
BUCKET_ORDER = ("R1", "R3", "R2")
LAW_TYPES = ("hienphap", "boluat", "luat")
FORM_WORDS = ("van ban de nghi", "mau so", "bieu mau", "to khai", "ho so", "ban chinh", "ban sao")
NUMBER_TYPES = (
    ("NQ-?HĐND|NQ-?CP|NQ-?TW|NQ-?UBTVQH|NQLT", "Nghị quyết"), ("NĐ-?CP", "Nghị định"), ("TTLT", "Thông tư liên tịch"), ("TT-", "Thông tư"),
    ("QĐ-", "Quyết định"), ("CT-", "Chỉ thị"), ("CV-", "Công văn"), (r"QH\d+", "Luật"),
)
MAJOR_ACTIONS = ("sua_doi_bo_sung", "thay_the", "bai_bo", "huy_bo", "dinh_chi", "ngung_hieu_luc", "dinh_chinh", "keo_dai_hieu_luc")

# --- end of fixed values ---


def issuer(kind: Column, place: Column, units: Column) -> Column:
    """draft, law, central or local; null without a type, place or unit. A law is central too."""
    centre = "(?iu)trung ương"
    is_centre = F.coalesce(place.rlike(centre), F.lit(False)) | F.coalesce(F.exists(units, lambda u: F.coalesce(u.rlike(centre), F.lit(False))), F.lit(False))
    somewhere = (F.trim(F.coalesce(place, F.lit(""))) != "") | F.coalesce(F.exists(units, lambda u: F.trim(F.coalesce(u, F.lit(""))) != ""), F.lit(False))
    known = F.coalesce(kind, F.lit("")) != ""
    return (
        F.when(known & kind.rlike("(?iu)^dự thảo"), "draft")
        .when(known & is_centre & kind.rlike("(?iu)^(luật|bộ luật|hiến pháp)"), "law")
        .when(known & is_centre, "central")
        .when(known & somewhere, "local")
    )


def year_bucket(year: Column) -> Column:
    out = F.lit("Y4")
    for name, a, b in reversed(YEAR_BUCKETS):
        out = F.when(year.between(a, b), name).otherwise(out)
    return out


def relation_bucket(title: Column, lists: Column, keys: dict[str, tuple[str, ...]]) -> Column:
    """R1, R3 or R2, in this order, by a curated list (map of key to array) that has values, or by words of the title; else R4."""
    lowered, out = F.lower(F.coalesce(title, F.lit(""))), F.lit("R4")
    for name in reversed(BUCKET_ORDER):
        here = F.lit(False)
        for key in keys.get(name, ()):
            here = here | F.coalesce(F.size(F.try_element_at(lists, F.lit(key))) > 0, F.lit(False))
        for word in BUCKET_TITLE_WORDS[name]:
            here = here | lowered.contains(word)
        out = F.when(here, name).otherwise(out)
    return out


def authority_level(*parts: Column) -> Column:
    """local if place, body or unit names a local authority, else central."""
    every = F.lower(F.concat_ws(" ", *parts))
    here = F.lit(False)
    for word in LOCAL_WORDS:
        here = here | every.contains(word)
    return F.when(here, "local").otherwise("central")


def keep_failed(kind: Column, information: Column) -> Column:
    """Whether a mention that was not resolved says enough to be kept."""
    said = F.trim(F.coalesce(information, F.lit("")))
    plain = F.regexp_replace(F.lower(fold_accents(said)), r"\s+", " ")
    form = (kind == "vanban") & plain.startswith("van ban") & plain.rlike(r"\b(" + "|".join(FORM_WORDS) + r")\b")
    vague = F.replace(plain, F.lit(" "), F.lit("")) == F.lower(kind)
    number = said.rlike(r"(?iu)(\bsố\s+)?\d+/\d{4}/[A-ZĐ\-]+|\b\d+/[A-ZĐ\-]+|(\bsố\s+)\d+")
    date = said.rlike(r"(?iu)\bngày\s+\d{1,2}|\b\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}|\bnăm\s+\d{4}\b")
    return F.coalesce((said != "") & ~vague & ~form & (kind.isin(*LAW_TYPES) | number | date | (F.length(said) > 30)), F.lit(False))


def unresolved_category(kind: Column, information: Column) -> Column:
    """law or nonlaw, by what the mention has: a full number, a date, or a title alone."""
    law = kind.isin(*LAW_TYPES)
    number = information.rlike(r"(?iu)\d+/(\d{4}/)?[A-ZĐ]+")
    date = information.rlike(r"(?iu)\bngày\s+\d{1,2}|\bnăm\s+\d{4}\b")
    return (
        F.when(law & number, "law_full_code").when(law & date, "law_title_date").when(law, "law_title_only").when(number, "nonlaw_full_code").when(date, "nonlaw_date").otherwise("nonlaw_title_internal")
    )


def type_from_number(number: Column) -> Column:
    out = F.lit("")
    for pattern, name in reversed(NUMBER_TYPES):
        out = F.when(number.rlike(f"(?iu){pattern}"), name).otherwise(out)
    return out


def display_reference(point: Column, clause: Column, article: Column, document: Column) -> Column:
    """A reference as text: levels that are given with their names, then the document."""
    part = lambda name, v: F.when(F.trim(v) != "", F.when(F.lower(v).startswith(name.lower()), F.trim(v)).otherwise(F.concat(F.lit(name + " "), F.trim(v))))
    return F.nullif(F.concat_ws(" ", part("điểm", point), part("khoản", clause), part("Điều", article), F.nullif(F.trim(document), F.lit(""))), F.lit(""))


def marked_text(text: Column, act: tuple[Column, Column], ref: tuple[Column, Column]) -> Column:
    """The text with [ACT] and [REF] about two ranges that don't overlap; a range outside the text is left out."""

    def put(said: Column, a: Column, b: Column, name: str) -> Column:
        inside = (a >= 0) & (a < b) & (b <= F.length(text))
        made = F.concat(F.substring(said, F.lit(1), a), F.lit(f"[{name}]"), F.substring(said, a + 1, b - a), F.lit(f"[/{name}]"), F.substring(said, b + 1, F.length(said)))
        return F.when(inside, made).otherwise(said)

    act_last = act[0] > ref[0]  # right to left, so that the other's offsets hold
    return F.when(act_last, put(put(text, *act, "ACT"), *ref, "REF")).otherwise(put(put(text, *ref, "REF"), *act, "ACT"))


def unique_abbreviations(titles: DataFrame, short: str, target: str) -> DataFrame:
    """short and target for abbreviations of one title only."""
    from weftline.operators.lookup import unique_targets

    return unique_targets(titles, [short], target)


def ambiguous(cues: Column, n_refs: Column, n_matches: Column, clause_only: Column) -> Column:
    """The first reason why rules may be wrong on a clause, null if none: an action without target, targets left over, mixed types, a target
    without document. cues is an array of relations."""
    has = lambda names: F.arrays_overlap(cues, F.array(*map(F.lit, names)))
    major = has(MAJOR_ACTIONS) | has(("quy_dinh_chi_tiet", "huong_dan"))
    both = F.array_contains(cues, "quy_dinh_chi_tiet") & F.array_contains(cues, "huong_dan")
    return (
        F.when(major & (n_matches == 0), "no_target")
        .when(major & (n_refs - n_matches >= 2), "left_over")
        .when(both, "mixed_guidance")
        .when(F.array_contains(cues, "dan_chieu") & has(MAJOR_ACTIONS), "mixed_citation")
        .when(clause_only, "clause_only")
    )


@F.pandas_udf(T.StringType())
def one_json_object(reply: pd.Series) -> pd.Series:
    """The JSON object in a noisy reply, as compact JSON; null if there is none that parses."""

    def one(text):
        if text is None:
            return None
        text = re.sub(r"(?s)<think>.*?</think>", "", text)
        decoder = json.JSONDecoder()
        for m in re.finditer(r"\{", text):
            try:
                found, _ = decoder.raw_decode(text, m.start())
                return json.dumps(found, ensure_ascii=False, separators=(",", ":"))
            except json.JSONDecodeError:
                continue
        return None

    return reply.map(one)
