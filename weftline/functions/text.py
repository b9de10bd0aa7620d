"""Text functions as column expressions; those that Spark has no built-in for are vectorised functions at the end."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.fixed import CLAUSE_LEVELS, INCOMPLETE_SUFFIXES, LEVEL_NAMES, POINT_LETTERS

_ACCENTED = "áàảãạăắằẳẵặâấầẩẫậéèẻẽẹêếềểễệíìỉĩịóòỏõọôốồổỗộơớờởỡợúùủũụưứừửữựýỳỷỹỵđ"


def _plain(c: str) -> str:
    return unicodedata.normalize("NFD", c.replace("đ", "d"))[0]


_FOLD_FROM = _ACCENTED + _ACCENTED.upper()
_FOLD_TO = "".join(map(_plain, _ACCENTED)) + "".join(map(_plain, _ACCENTED)).upper()


def fold_accents(text: Column) -> Column:
    """Composed Vietnamese letters to ASCII; other characters stay. Use nfc() first where text may be decomposed."""
    return F.translate(text, _FOLD_FROM, _FOLD_TO)


def clean_markup(text: Column) -> Column:
    """Tables, the end marker with what follows it, and numbered footnotes go, in this order."""
    for pattern in (r"(?s)\[TABLE\].*?\[\\TABLE\]", r"(?s)\[TABLE\].*", r"(?is)<table[^>]*>.*?</table>", r"(?s)\./\..*", r"(?s)\[\d+\].*?(?=\[\d+\]|$)"):
        text = F.regexp_replace(text, pattern, "")
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def tidy_lines(text: Column) -> Column:
    """Runs of blanks and tabs to one blank, lines trimmed, empty lines dropped."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r\x0b\x0c]"), lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def drop_reasons(text: Column) -> Column:
    return tidy_lines(F.regexp_replace(text, r"Lý do(?: (?:bãi bỏ|thay thế))?[^.]*\.", ""))


def drop_quoted(text: Column) -> Column:
    """Double-quoted, then single-quoted spans go; the lines are tidied."""
    text = F.regexp_replace(text, "(?s)[\"“”].*?[\"“”]", "")
    return tidy_lines(F.regexp_replace(text, "(?s)['‘’].*?['‘’]", ""))


def cut_after_effect(text: Column, doc_types: list[str]) -> Column:
    """The text up to and with the first phrase, in the order of doc_types, that ends a document's effect; else all of it."""
    out = text
    for name in reversed(doc_types):
        phrase = f"hết hiệu lực kể từ ngày {name} này có hiệu lực thi hành"
        at = F.locate(phrase, text)
        out = F.when(at > 0, F.trim(F.substring(text, F.lit(1), at + F.lit(len(phrase) - 1)))).otherwise(out)
    return out


def basis_lines(text: Column) -> Column:
    """Struct of basis (lines that start with the legal-basis cue) and rest (the others), both trimmed."""
    lines = F.split(text, "\n")
    basis = F.array_join(F.filter(lines, lambda x: x.startswith("Căn cứ")), "\n")
    rest = F.array_join(F.filter(lines, lambda x: ~x.startswith("Căn cứ")), "\n")
    return F.struct(F.trim(basis).alias("basis"), F.trim(rest).alias("rest"))


def is_consolidated(number: Column) -> Column:
    return F.upper(number).contains("VBHN")


def before_basis(text: Column) -> Column:
    """What comes before the first legal-basis cue."""
    return F.regexp_extract(text, r"(?iusU)^(.*?)(?:\bCăn\s+cứ\b.*)?$", 1)


# Document numbers


def fold_number(number: Column) -> Column:
    """Without the leading word for number, accents and blanks; all dashes alike."""
    out = F.regexp_replace(F.trim(F.coalesce(number, F.lit(""))), r"(?iu)^\s*số\s+", "")
    out = F.regexp_replace(fold_accents(out), r"[‐-―]", "-")
    return F.regexp_replace(F.regexp_replace(out, r"\s*([/-])\s*", "$1"), r"\s+", "")


def number_key(number: Column) -> Column:
    return F.upper(fold_number(number))


def number_variants(number: Column) -> Column:
    """Spellings that count as the same number, without repeats, the given one first."""
    raw, folded = F.trim(F.coalesce(number, F.lit(""))), fold_number(number)
    found = [raw, F.upper(raw), F.lower(raw), folded, F.upper(folded), F.lower(folded), F.regexp_replace(raw, r"[\s\\-]+", "/"), F.regexp_replace(raw, r"[\s/\\]+", "-")]
    return F.filter(F.array_distinct(F.array(*found)), lambda x: x != "")


def issue_date(text: Column) -> Column:
    """Struct day, month, year of the first date: with slashes, hyphens or words, then month and year, year, bare year."""
    ordered = (
        (r"(?iu)ngày\s+(\d{1,2})/(\d{1,2})/(\d{4})", 1, 2, 3),
        (r"(?iu)ngày\s+(\d{1,2})-(\d{1,2})-(\d{4})", 1, 2, 3),
        (r"(?iu)ngày\s+(\d{1,2})\s+tháng\s+(\d{1,2})\s+năm\s+(\d{4})", 1, 2, 3),
        (r"(?iu)tháng\s+(\d{1,2})\s+năm\s+(\d{4})", 0, 1, 2),
        (r"(?iu)năm\s+(\d{4})", 0, 0, 1),
    )
    none = F.lit(None).cast("string")

    def part(pattern: str, group: int) -> Column:
        return F.lpad(F.regexp_extract(text, pattern, group), 2, "0") if group else none

    bare = F.regexp_extract(text, r"\s(\d{4})(?!\d)", 1).try_cast("int")
    out = F.when(bare.between(1900, 2100), F.struct(none.alias("day"), none.alias("month"), bare.alias("year")))
    for pattern, d, m, y in reversed(ordered):
        here = F.struct(part(pattern, d).alias("day"), part(pattern, m).alias("month"), F.regexp_extract(text, pattern, y).try_cast("int").alias("year"))
        out = F.when(F.regexp_like(text, F.lit(pattern)), here).otherwise(out)
    return out


def date_matches(wanted_year: Column, wanted_month: Column, wanted_day: Column, iso: Column) -> Column:
    """The parts that are wanted equal those of an ISO date string; a part that isn't wanted always fits."""
    year, month, day = (F.regexp_extract(iso, r"^(\d{4})-(\d{2})-(\d{2})", k) for k in (1, 2, 3))
    fits = lambda want, have: want.isNull() | (F.lpad(want.cast("string"), 2, "0") == have)
    return (wanted_year.isNull() | (wanted_year.cast("string") == year)) & fits(wanted_month, month) & fits(wanted_day, day)


# Clause keys, child first: diem_a_khoan_2_dieu_14


def graph_parent_key(key: Column) -> Column:
    """The key without its first level; null for an article, which hangs off the document."""
    parts = F.split(key, "_")
    rest = F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), "_")
    return F.when(~key.startswith("dieu") & (F.size(parts) > 2), rest)


def extract_parent_candidate(key: Column) -> Column:
    """The key from its next level name on; a parent only if a clause has that key."""
    parts = F.split(key, "_")
    at = F.array_min(F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.coalesce(F.get(parts, i).isin(*CLAUSE_LEVELS), F.lit(False))), lambda i: i))
    return F.when((F.size(parts) >= 3) & at.isNotNull(), F.array_join(F.slice(parts, at + 1, F.size(parts)), "_"))


def readable_key(key: Column) -> Column:
    """A key as text, such as Khoản 1 Điều 219; levels with an odd value are left out."""
    parts = F.split(key, "_")

    def say(i: Column) -> Column:
        value = F.coalesce(F.get(parts, i + 1), F.lit(""))
        out = F.lit(None).cast("string")
        for level, name in LEVEL_NAMES.items():
            ok = value.rlike(r"(?U)^(?:\d+|\p{L}+)$" if level == "diem" else r"(?U)^[\p{L}\d]+$" if level == "dieu" else r"^\d+$")
            out = F.when((F.get(parts, i) == level) & ok, F.concat(F.lit(name + " "), value)).otherwise(out)
        return out

    said = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), say)
    return F.array_join(F.filter(said, lambda x: x.isNotNull()), " ")


def compose_key(point: Column, clause: Column, article: Column) -> Column:
    """The key of the levels that are given, child first."""
    return F.concat_ws("_", F.concat(F.lit("diem_"), point), F.concat(F.lit("khoan_"), clause), F.concat(F.lit("dieu_"), article))


def key_value(value: Column, level: str) -> Column:
    """A component's value as it stands in a key: letters of points keep đ, others are ASCII; no dots."""
    out = F.regexp_replace(F.lower(F.trim(value)), r"[.\s]+", "")
    return out if level == "diem" else fold_accents(out)


def point_range(first: Column, last: Column) -> Column:
    """The letters from first to last in the alphabet of points; empty if out of order."""
    letters = F.array(*map(F.lit, POINT_LETTERS.split()))
    a, b = F.array_position(letters, first), F.array_position(letters, last)
    return F.when((a > 0) & (b >= a), F.slice(letters, a.cast("int"), (b - a + 1).cast("int"))).otherwise(F.array().cast("array<string>"))


def valid_shape(levels: Column) -> Column:
    """Whether an array of level names is a shape that a reference may have."""
    from weftline.functions.fixed import VALID_CLAUSE_SHAPES

    return F.array_join(F.array_sort(levels), ",").isin(*[",".join(sorted(s)) for s in VALID_CLAUSE_SHAPES])


def longest_quoted(text: Column) -> Column:
    """The longest quoted block, without its quotes; null if none."""
    found = F.regexp_extract_all(text, F.lit('(?s)["“]([^"“”]*)["”]'), F.lit(1))
    return F.array_max(F.transform(found, lambda x: F.struct(F.length(x).alias("n"), F.trim(x).alias("x"))))["x"]


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(fold_accents(text)), r"[^a-z0-9]+"), lambda x: x != "")


def token_overlap(a: Column, b: Column) -> Column:
    """Share of the smaller token set that the other has; 0 if one is empty."""
    a, b = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


def token_jaccard(a: Column, b: Column) -> Column:
    a, b = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def stable_id(*parts: Column) -> Column:
    """The first 20 hex digits of the SHA-1 of the parts, joined by the unit separator; null parts are empty."""
    return F.substring(F.sha1(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 20)


def hash_bucket(value: Column) -> Column:
    """The first 32 bits of a SHA-1 as a number."""
    return F.conv(F.substring(F.sha1(value), 1, 8), 16, 10).cast("long")


#: Years from, to and the assembly's term in numbers; the first that holds counts.
TERMS = ((2011, 2016, "QH13"), (2016, 2021, "QH14"), (2021, 2026, "QH15"))


def corrected_term(number: Column) -> Column:
    """The number with the assembly's term that belongs to its year; of two terms in a change-over year either stands."""
    year = F.regexp_extract(number, r"(?i)/(\d{4})/QH\d+\b", 1).try_cast("int")
    said = F.upper(F.regexp_extract(number, r"(?i)/\d{4}/(QH\d+)\b", 1))
    out = number
    for a, b, term in reversed(TERMS):
        out = F.when(year.between(a, b) & (said != term), F.regexp_replace(number, r"(?i)(/\d{4}/)QH\d+\b", f"$1{term}")).otherwise(out)
    right = F.lit(False)
    for a, b, term in TERMS:
        right = right | (year.between(a, b) & (said == term))
    return F.when(F.coalesce(right, F.lit(False)), number).otherwise(out)


# Vectorised: Spark has no such function


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(T.StringType())
def unidecode(text: pd.Series) -> pd.Series:
    """ASCII by compatibility decomposition; what has none is dropped."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x.replace("Đ", "D").replace("đ", "d")).encode("ascii", "ignore").decode())


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks; not an edit distance."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype=object)


# How much a number or an authority tells


def is_specific_number(number: Column) -> Column:
    """Whether a number says who issued it: after its first number, the last part is more than a type's code."""
    key = number_key(number)
    last = F.element_at(F.split(key, "/"), -1)
    tells = last.contains("-") | last.rlike(r"^(QH|UBTVQH)\d{1,3}$") | last.rlike("[A-Z]{2}")
    return key.rlike(r"^\d+/") & ~last.isin(*sorted({*INCOMPLETE_SUFFIXES, *(s.replace("Đ", "D") for s in INCOMPLETE_SUFFIXES)})) & tells


def extends_number(longer: Column, number: Column) -> Column:
    """Whether a number of several agencies, in which some may be left out, starts another one that is longer."""
    key, other = number_key(number), number_key(longer)
    last = F.element_at(F.split(key, "/"), -1)
    several = key.contains("/") & (F.size(F.split(last, "-")) >= 3) & last.rlike("[A-Z]")
    return several & (key != other) & other.startswith(key)


#: Short names of local bodies.
_BODIES = (("ubnd", "ủy ban nhân dân"), ("hđnd", "hội đồng nhân dân"), ("hdnd", "hội đồng nhân dân"))


def authority_key(name: Column) -> Column:
    """An issuing body's name in small plain letters, with the short names of local bodies written out."""
    out = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    for short, full in _BODIES:
        out = F.replace(out, F.lit(short), F.lit(full))
    return F.trim(F.regexp_replace(F.regexp_replace(fold_accents(out), r"[^a-zA-Z0-9_\s]", " "), r"\s+", " "))


def same_authority(a: Column, b: Column) -> Column:
    """Whether one of two names contains the other; empty ones match nothing."""
    a, b = authority_key(a), authority_key(b)
    return (a != "") & (b != "") & (a.contains(b) | b.contains(a))


def cacheable(information: Column, source_authority: Column, source_number: Column) -> Column:
    """Whether what a reference resolves to may be kept for all documents: it has a number with a letter or a date, and if the source is a
    local body's document, that body is known."""
    said = F.coalesce(information, F.lit(""))
    numbered = said.rlike(r"\d+\s*/\s*(\d{4}\s*/\s*)?[\p{L}]{2,}")
    dated = said.rlike(r"(?iu)ngày\s+\d{1,2}\s*([/-]\s*\d{1,2}\s*[/-]\s*\d{4}|tháng\s+\d{1,2}\s+năm\s+\d{4})|năm\s+\d{4}")
    local = F.element_at(F.split(F.coalesce(source_number, F.lit("")), "/"), -1).rlike("UBND|HĐND|HDND")
    return (numbered | dated) & (~local | (F.trim(F.coalesce(source_authority, F.lit(""))) != ""))
