"""Line dedup: content-defined chunks of lines, and removal of those that repeat anywhere.

A chunk counts if it has min_words words, or two lines with words and MULTI words in all. From each line with words the least chunk
that counts is formed, once forwards and once backwards; blank lines never start, end or lengthen one. Where a chunk ends thus
follows from its content alone, whatever stands before or behind it, so of a passage that counts and repeats every line goes: a line
whose chunk forwards leaves the passage lies in the chunk backwards from the passage's end. A chunk has at most MULTI lines with
words, so a text has at most two chunks a line, of bounded words but for long lines.

Chunks are grouped by hash and length with a
partial aggregation that keeps the first and last occurrence, so a hot chunk moves a row per task. The texts of repeated chunks alone
are moved then, and an occurrence is removed only if its bytes equal those of the first one. The first occurrence, by doc_id and
place, stays; of one that overlaps it, the lines behind it go. Joins are sort-merge joins that Spark can split where a key is hot;
nothing gathers a group in one place.

Defined results. Null text stays null, with no lines. A text whose lines all went is empty. Blank lines between two removed chunks go
with them. Rows equal in doc_id and text are one
document: each gets the same result, and they don't count as repeats of each other. Rows with one doc_id and other texts are
documents of their own. Null doc_ids sort first. Extra columns stay as they are, whatever their names, but for the added
n_lines and n_removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import stored

MIN_WORDS = 50
#: Words of a chunk of several lines.
MULTI = 25
WORD = r"[^\x20\x09-\x0D]+"


def _grown(words: Column, min_words: int) -> Column:
    """For each line with words (words has no others), how many lines behind it its least chunk takes; null if no chunk counts."""
    need = min(MULTI, min_words)

    def grown(w: Column, i: Column) -> Column:
        start = F.struct(w.cast("long").alias("t"), F.lit(0).alias("n"))
        more = lambda s, x: F.when((s["n"] > 0) & (s["t"] >= need), s).otherwise(F.struct((s["t"] + x).alias("t"), (s["n"] + 1).alias("n")))
        enough = lambda s: F.when((s["n"] > 0) & (s["t"] >= need), s["n"])
        return F.when(w >= min_words, 0).otherwise(F.aggregate(F.slice(words, i + 2, max(1, need)), start, more, enough))

    return F.transform(words, grown)


def _chunks(at: Column, on: Column, back: Column, n: Column) -> Column:
    """Distinct (a, b, c) of all chunks: lines a + 1 to b, and c, the blank lines behind it included. at: the places (from 0) of the
    lines with words; on, back: what _grown gives for them and for them in reverse."""

    def chunk(first: Column, last: Column) -> Column:
        return F.struct(F.get(at, first).alias("a"), (F.get(at, last) + 1).alias("b"), F.coalesce(F.get(at, last + 1), n).alias("c"))

    forwards = F.transform(on, lambda k, i: F.when(k.isNotNull(), chunk(i, i + k)))
    backwards = F.transform(back, lambda k, i: F.when(k.isNotNull(), chunk(F.size(at) - 1 - i - k, F.size(at) - 1 - i)))
    return F.array_distinct(F.filter(F.concat(forwards, backwards), lambda x: x.isNotNull()))


def _merged(gone: Column) -> Column:
    """The ranges (a, b, c) in order, joined where they overlap or only blank lines lie between them."""
    kind = "array<struct<a:int,b:int,c:int>>"

    def merge(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        both = F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"), F.greatest(last["c"], r["c"]).alias("c"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))
        return F.when(r["a"] <= last["c"], joined).otherwise(F.concat(done, F.array(r))).cast(kind)

    return F.aggregate(F.array_sort(gone), F.array().cast(kind), merge)


def _exploded(cut: DataFrame, *fields: str) -> DataFrame:
    """A row for each struct of _c: its fields and t, the text of its lines."""
    lines = F.col("_lines")
    rows = F.transform("_c", lambda x: F.struct(*[x[f].alias(f) for f in fields], F.array_join(F.slice(lines, x["a"] + 1, x["b"] - x["a"]), "\n").alias("t")))
    return cut.select("_id", "_k", F.explode(rows).alias("c")).select("_id", "_k", "c.*")


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_id, _k of each document that loses lines, and _gone: its (a, b) ranges. docs has _id, _k, _text."""
    lined = docs.where("_text IS NOT NULL").select("_id", "_k", F.split("_text", "\n").alias("_lines"))
    words = F.transform("_lines", lambda x: F.regexp_count(x, F.lit(WORD)))
    some = F.filter("_w", lambda w: w > 0)
    places = F.filter(F.transform("_w", lambda w, i: F.when(w > 0, i)), lambda i: i.isNotNull())
    cut = (
        lined.select("_id", "_k", "_lines", words.alias("_w"))
        .select("_id", "_k", "_lines", places.alias("_at"), some.alias("_w"), F.reverse(some).alias("_r"))
        .select("_id", "_k", "_lines", "_at", _grown(F.col("_w"), min_words).alias("_on"), _grown(F.col("_r"), min_words).alias("_back"))
        .select("_id", "_k", "_lines", _chunks(F.col("_at"), F.col("_on"), F.col("_back"), F.size("_lines")).alias("_c"))
    )
    chunk = _exploded(cut, "a", "b", "c").select("_id", "_k", "a", "b", "c", F.xxhash64("t").alias("h"), F.octet_length("t").alias("n"))
    chunk = stored(chunk, "line_chunks")
    place = F.struct("_id", "_k", "a")
    repeated = chunk.groupBy("h", "n").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("h", "n", "first")
    own = F.col("first._id").eqNullSafe(F.col("_id")) & (F.col("first._k") == F.col("_k"))
    # Where the lines to remove begin: behind the first occurrence, if that overlaps.
    begin = F.when(own, F.greatest("a", F.col("first.a") + F.col("b") - F.col("a"))).otherwise(F.col("a"))
    is_first = (own & (F.col("first.a") == F.col("a"))).alias("is_first")
    found = chunk.join(repeated, ["h", "n"]).select("h", "n", "_id", "_k", "a", "b", "c", begin.alias("begin"), is_first)
    per_doc = found.groupBy("_id", "_k").agg(F.collect_set(F.struct("h", "n", "a", "b", "c", "begin", "is_first")).alias("_c"))
    own = docs.alias("d").join(per_doc.alias("c"), (F.col("d._k") == F.col("c._k")) & F.col("d._id").eqNullSafe(F.col("c._id")))
    cut = own.select("d._id", "d._k", F.split("d._text", "\n").alias("_lines"), "c._c")
    texts = stored(_exploded(cut, "h", "n", "b", "c", "begin", "is_first"), "line_texts")
    first = texts.where("is_first").groupBy("h", "n").agg(F.min("t").alias("t1"))
    same = texts.where("NOT is_first").join(first, ["h", "n"]).where("t = t1")
    gone = same.groupBy("_id", "_k").agg(F.collect_set(F.struct(F.col("begin").alias("a"), "b", "c")).alias("_gone"))
    return gone.select("_id", "_k", _merged(F.col("_gone")).alias("_gone"))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of docs with repeated chunks of lines taken out of text, and n_lines, n_removed (lines)."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    whole = docs.select(F.struct(*kept).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("doc_id", "text").alias("_k"))
    gone = removals(whole.select("_id", "_k", F.col("_row.text").alias("_text")), min_words)
    joined = whole.alias("d").join(gone.alias("g"), (F.col("d._k") == F.col("g._k")) & F.col("d._id").eqNullSafe(F.col("g._id")), "left")
    lines = F.split("_row.text", "\n")
    left = F.filter(lines, lambda x, i: ~F.exists("_gone", lambda r: (i >= r["a"]) & (i < r["b"])))
    out = joined.select("d._row", "g._gone", F.when(F.col("_gone").isNull(), lines).otherwise(left).alias("_left"))
    n_lines = F.when(F.col("_row.text").isNull(), 0).otherwise(F.size(lines))
    text = F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(F.array_join("_left", "\n"))
    return out.select(
        *[text.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in kept],
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("_row.text").isNull(), 0).otherwise(F.size(lines) - F.size("_left")).cast("long").alias("n_removed"),
    )
