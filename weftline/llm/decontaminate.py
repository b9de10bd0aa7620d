"""Benchmark decontamination: a positional inverted index of the training text, searched for the benchmark's phrases.

Index. One scan of the documents stores a posting (term, row, pos) for each word; a term is a word's 64-bit hash, so that sorting and
meeting compare numbers (of 10^9 words of a corpus and 10^4 of a benchmark, two have one hash with a chance of 10^-6). Each task
writes the postings of its own documents sorted by term, so the index is dealt out by documents, needs no shuffle, and a term's
list is one stretch of each file. A posting with term END, a key and pos = number of words closes each document and carries its id. The
index knows nothing of the benchmark; any phrases can be asked for.

Search. A window is WINDOW consecutive words of an item (all of them, if it has fewer). Of each window the two rarest terms by
their number of postings are looked up first; their lists, each shifted by the term's place in the item, are intersected on
(document, item, shift). What is left is intersected with the postings of all the window's other terms in those documents, which
gives the exact phrase matches. A window with a word that the corpus lacks is never looked up.

Near matches, with all terms of a window within REACH words of its rarest one in any order, are found in the same index: the lists of
the two rarest terms meet first, by stretches of REACH words, and what is left meets those of the other terms.

What is broadcast, the items' terms and windows and the documents in question, is summed up first and must be under BROADCAST_BYTES;
else it is joined by shuffle.

Defined results. Null or wordless text: no words, not contaminated. Null or wordless items have no windows. Repeated items count
once by item_id; an item without id hits words but is not counted among the items. Repeated documents give a row each, with the
same result. Empty benchmark: nothing is hit. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import BROADCAST_BYTES, ascii_lower, discard, free_name, stored

WINDOW = 13
#: What separates words, after A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words to either side of a window's rarest term that a near match may take.
REACH = 26
END = -1


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), GAP), ""), F.array().cast("array<string>"))


def _small(df: DataFrame, size: str = "0") -> DataFrame:
    """df with a broadcast hint if its rows, of 48 and size bytes each, are small together."""
    return F.broadcast(df) if (df.agg(F.sum(F.expr(f"48 + {size}"))).first()[0] or 0) <= BROADCAST_BYTES else df


@dataclass(frozen=True)
class Index:
    """postings: term, row, pos; doc_id and key (a hash of id and text) in END rows only."""

    postings: DataFrame

    def of(self, sought: DataFrame) -> DataFrame:
        """The postings of the terms in sought's column term, joined with it."""
        return self.postings.where("key IS NULL").select("term", "row", "pos").join(_small(sought), "term")


def build_index(docs: DataFrame) -> Index:
    # Row numbers are made in a select of their own: beside explode() they would number the exploded rows.
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("doc_id", "text").alias("key"), F.array_append(words(F.col("text")), F.lit("")).alias("w"))
    found = numbered.select("row", "doc_id", "key", (F.size("w") - 1).alias("n"), F.posexplode("w").alias("pos", "word"))
    closing = F.col("pos") == F.col("n")
    term = F.when(closing, F.lit(END).cast("long")).otherwise(F.xxhash64("word")).alias("term")
    postings = found.select(term, "row", "pos", F.when(closing, F.col("doc_id")).alias("doc_id"), F.when(closing, F.col("key")).alias("key"))
    # One number to sort by is what Spark sorts fastest; a task's documents come in order already.
    return Index(stored(postings.sortWithinPartitions("term"), "postings"))


def phrases(benchmark: DataFrame) -> DataFrame:
    """Stored: item, item_id, ipos, term of each word of each item."""
    items = benchmark.select("item_id", "text").distinct().select(F.monotonically_increasing_id().alias("item"), "item_id", words(F.col("text")).alias("w"))
    items = items.select("item", "item_id", F.posexplode("w").alias("ipos", "word"))
    return stored(items.select("item", "item_id", "ipos", F.xxhash64("word").alias("term")), "benchmark_terms")


def windows(index: Index, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Stored: item, item_id and spans: an array of (s, e, p1, p2), the item positions of each window that may occur and of its two
    rarest terms."""
    counts = index.of(items.select("term").distinct()).groupBy("term").agg(F.count("*").alias("n"))
    per_item = items.join(counts, "term", "left").groupBy("item", "item_id").agg(F.array_sort(F.collect_list(F.struct("ipos", F.coalesce("n", F.lit(0)).alias("n")))).alias("t"))
    last = F.greatest(F.size("t") - size, F.lit(0))

    def span(s: Column) -> Column:
        part = F.slice(F.col("t"), s + 1, size)
        rare = F.array_sort(F.transform(part, lambda x: F.struct(x["n"].alias("n"), x["ipos"].alias("ipos"))))
        second = F.get(rare, F.least(F.size(part) - 1, F.lit(1)))
        return F.struct(
            s.alias("s"), (s + F.size(part) - 1).alias("e"), F.get(rare, F.lit(0))["ipos"].alias("p1"), second["ipos"].alias("p2"), F.get(rare, F.lit(0))["n"].alias("least")
        )

    spans = F.filter(F.transform(F.sequence(F.lit(0), last), span), lambda x: x["least"] > 0)
    return stored(per_item.select("item", "item_id", spans.alias("spans")).where(F.size("spans") > 0), "windows")


def _inside(spans: str, test) -> Column:
    return F.filter(spans, test)


def phrase_matches(index: Index, items: DataFrame, sought: DataFrame) -> DataFrame:
    """row, item, item_id, shift, spans: the windows of the item (of sought) that occur in the document with that shift (document
    position less item position)."""
    placed = items.select("item", "ipos", "term")
    anchors = (
        sought.select("item", F.explode("spans").alias("w")).select("item", F.explode(F.array_distinct(F.array("w.p1", "w.p2"))).alias("ipos")).distinct().join(placed, ["item", "ipos"])
    )
    sought = _small(sought, "24 * size(spans)")
    met = index.of(anchors).groupBy("row", "item", (F.col("pos") - F.col("ipos")).alias("shift")).agg(F.collect_set("ipos").alias("got"))
    both = _inside("spans", lambda w: F.array_contains("got", w["p1"]) & F.array_contains("got", w["p2"]))
    maybe = met.join(sought, "item").select("row", "item", "shift", both.alias("spans")).where(F.size("spans") > 0)
    maybe = stored(maybe, "phrase_candidates")
    expected = (
        maybe.select("row", "item", "shift", F.explode(F.array_distinct(F.flatten(F.transform("spans", lambda w: F.sequence(w["s"], w["e"]))))).alias("ipos"))
        .join(_small(placed), ["item", "ipos"])
        .withColumn("pos", F.col("shift") + F.col("ipos"))
    )
    there = index.postings.where("key IS NULL").select("term", "row", "pos").join(_small(maybe.select("row").distinct()), "row", "left_semi")
    got = expected.join(there, ["row", "pos", "term"]).groupBy("row", "item", "shift").agg(F.collect_set("ipos").alias("got"))
    whole = _inside("spans", lambda w: F.size(F.array_intersect(F.sequence(w["s"], w["e"]), F.col("got"))) == w["e"] - w["s"] + 1)
    return got.join(sought, "item").select("row", "item", "item_id", "shift", whole.alias("spans")).where(F.size("spans") > 0)


def near_matches(index: Index, items: DataFrame, sought: DataFrame, reach: int = REACH) -> DataFrame:
    """row, item, s, pos: the window of the item that starts at s has all its distinct terms within reach words of pos, where its
    rarest term stands, in any order. Places are cut into stretches of reach words, so that the lists meet by equality."""
    spans = sought.select("item", F.explode("spans").alias("w")).select("item", "w.s", "w.e", "w.p1", "w.p2")
    placed = items.select("item", "ipos", "term")
    first = spans.join(placed.withColumnRenamed("ipos", "p1"), ["item", "p1"]).select("item", "s", "p2", "term")
    second = spans.join(placed.withColumnRenamed("ipos", "p2"), ["item", "p2"]).select("item", "s", F.col("term").alias("other"))
    # Windows with the same two rarest terms go together until those have met.
    pairs = stored(first.join(second, ["item", "s"]).select("term", "other", "item", "s"), "near_pairs")
    anchors = pairs.select("term", "other").distinct()
    around = lambda c: F.explode(F.array(*[F.floor(F.col(c) / reach) + d for d in (-1, 0, 1)]))
    centre = index.of(anchors).select("term", "other", "row", F.col("pos").alias("c"), around("pos").alias("cell"))
    lists = index.of(anchors.select(F.col("other").alias("term")).distinct()).select(F.col("term").alias("other"), "row", F.floor(F.col("pos") / reach).alias("cell"), "pos")
    met = centre.join(lists, ["other", "row", "cell"]).where(F.abs(F.col("pos") - F.col("c")) <= reach).select("term", "other", "row", "c").distinct()
    met = stored(met, "near_candidates")
    needed = spans.join(placed, "item").where("ipos BETWEEN s AND e").groupBy("item", "s").agg(F.collect_set("term").alias("terms"))
    needed = stored(pairs.join(needed, ["item", "s"]), "near_terms")
    reachable = met.join(_small(needed, "16 * size(terms) + 64"), ["term", "other"]).select("row", "item", "s", "c", F.size("terms").alias("n"), F.explode("terms").alias("term"))
    reachable = reachable.withColumn("cell", around("c"))
    there = index.postings.select("term", "row", "pos").join(_small(met.select("row").distinct()), "row", "left_semi")
    lists = there.join(_small(items.select("term").distinct()), "term").select("term", "row", "pos", F.floor(F.col("pos") / reach).alias("cell"))
    near = reachable.join(lists, ["row", "term", "cell"]).where(F.abs(F.col("pos") - F.col("c")) <= reach)
    return near.groupBy("row", "item", "s", "c", "n").agg(F.count_distinct("term").alias("k")).where("k = n").select("row", "item", "s", F.col("c").alias("pos"))


def contamination(index: Index, benchmark: DataFrame, size: int = WINDOW, near: bool = False) -> DataFrame:
    """doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated, item_ids of each document row, and with near n_near, the number of
    items that have a window near in it."""
    items = phrases(benchmark)
    sought = windows(index, items, size)
    hits = phrase_matches(index, items, sought).groupBy("row").agg(
        F.array_distinct(F.flatten(F.collect_list(F.flatten(F.transform("spans", lambda w: F.sequence(w["s"] + F.col("shift"), w["e"] + F.col("shift"))))))).alias("at"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
    )
    closing = index.postings.where("key IS NOT NULL").select("row", "doc_id", "key", F.col("pos").cast("long").alias("n_words"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    out = closing.join(hits.select("row", F.size("at").cast("long").alias("n_hit"), "item_ids"), "row", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    columns = ["doc_id", "key", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256")]
    columns += [((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), ids.alias("item_ids")]
    if near:
        close = near_matches(index, items, sought).groupBy("row").agg(F.count_distinct("item").alias("n_near"))
        out = out.join(close, "row", "left")
        columns.append(F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))
    return out.select(*columns)


def benchmark_decontamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and n_near of each row of docs."""
    return contamination(build_index(docs), benchmark, size, near=True).drop("key", "item_ids")


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of docs that are not contaminated."""
    index = build_index(docs)
    bad_id, bad_key = free_name(docs, "bad_id"), free_name(docs, "bad_key")
    bad = contamination(index, benchmark, size).where("contaminated").select(F.col("doc_id").alias(bad_id), F.col("key").alias(bad_key)).distinct()
    bad = stored(bad, "contaminated")
    discard(index.postings)
    return docs.join(_small(bad), (F.xxhash64(docs["doc_id"], docs["text"]) == bad[bad_key]) & docs["doc_id"].eqNullSafe(bad[bad_id]), "left_anti")
