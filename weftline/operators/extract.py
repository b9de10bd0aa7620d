"""From clauses to relations: text rules once over each clause in Arrow batches, everything else by column."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.authority import with_policy
from weftline.functions.fixed import RELATION_PRIORITY
from weftline.functions.text import clean_markup, drop_reasons, extract_parent_candidate, is_consolidated
from weftline.operators.relations import best_relation, mapped
from weftline.sources.scratch import stored

_REF = "point string, clause string, article string, key string, doc_type string, number string, date string, title string, own boolean"
_FIELDS = [("relation", pa.string()), ("cue", pa.string()), ("cue_start", pa.int32()), ("cue_stop", pa.int32()), ("inherited", pa.bool_()), ("ref_start", pa.int32()), ("ref_stop", pa.int32())]
_REF_FIELDS = [(x.split()[0], pa.bool_() if x.endswith("boolean") else pa.string()) for x in _REF.split(", ")]
#: A text without any of these is clean: signs of tables, footnotes and the end marker, reasons, other blanks than single ones, and more lines than one.
_SIGNS = ("[", "<", "./.", "Lý do", "  ", "\t", "\n", "\r", "\x0b", "\x0c")
_ENDS = (" ", " \u0085", " \u2028", " \u2029")


def unclean(text: Column) -> Column:
    """Whether a text may have something that cleaning changes; plain search costs a quarter of one pattern."""
    found = [F.contains(text, F.lit(s)) for s in _SIGNS] + [F.startswith(text, F.lit(" "))] + [F.endswith(text, F.lit(s)) for s in _ENDS]
    return reduce(Column.__or__, found)


def with_parents(clauses: DataFrame) -> DataFrame:
    """clauses (doc_id, com_key, text) with parent_key and parent_text: the next level up, if the document has that clause."""
    named = clauses.withColumn("_up", extract_parent_candidate(F.col("com_key")))
    above = clauses.select("doc_id", F.col("com_key").alias("_up"), F.col("text").alias("parent_text")).dropDuplicates(["doc_id", "_up"])
    joined = named.join(above, ["doc_id", "_up"], "left")
    return joined.withColumn("parent_key", F.when(F.col("parent_text").isNotNull(), F.col("_up"))).drop("_up")


def cleaned(clauses: DataFrame) -> DataFrame:
    """Clauses whose text is left after markup and reasons are gone, each text of a key once. Equal ones of all documents come to one partition, where
    the rules are run once for all of them.

    The number of partitions is set, since what follows costs CPU by clause and should not be packed into few tasks by size."""
    text = F.when(unclean(F.col("text")), drop_reasons(clean_markup(F.col("text")))).otherwise(F.col("text"))
    parts = int(clauses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["doc_id", "com_key", "text"]
    return clauses.withColumn("text", text).where("text <> ''").repartition(parts, "com_key", "text").dropDuplicates(keys)


def matched(clauses: DataFrame) -> DataFrame:
    """A row for each cue and mention that it takes: doc_id, com_key, relation, the cue, whether it is the parent's, the mention.

    A clause without a cue of its own takes the last forward one of a parent that ends with a colon; mentions without a document
    take the parent's last one. clauses has doc_id, com_key, text and parent_text. Equal clauses of a partition are put one after the other, and what
    they say is worked out once."""
    fields = [*_FIELDS, *_REF_FIELDS]
    names = ["doc_id", "com_key", *[n for n, _ in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        from weftline.functions import clause_text as C

        def starts(batch: pa.RecordBatch) -> np.ndarray:
            """The rows whose clause is not that of the row before."""
            new = np.ones(batch.num_rows, bool)
            if batch.num_rows > 1:
                new[1:] = False
                for c in ("com_key", "text", "parent_text"):
                    a, b = batch[c].slice(1), batch[c].slice(0, batch.num_rows - 1)
                    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
                    new[1:] |= ~same.to_numpy(zero_copy_only=False)
            return np.flatnonzero(new)

        def told(key: str | None, text: str, up: str | None) -> list[tuple]:
            pairs = [(c, m, False) for c, m in C.matches(text, key or "")]
            if up:
                acts = [c for c in C.cues(up) if c.reason is None and not c.backward]
                above = [m for m in C.mentions(up) if m.doc_type and not m.own]
                if not pairs and acts and up.rstrip().endswith(":"):
                    pairs = [(acts[-1], m, True) for m in C.mentions(text, key or "")]
                if above:
                    d = above[-1]
                    pairs = [(c, C.replace(m, doc_type=d.doc_type, number=d.number, date=d.date, title=d.title) if m.doc_type is None and not m.own else m, i) for c, m, i in pairs]
            return [
                (c.relation, c.text, *((-1, -1) if i else (c.start, c.stop)), i, m.start, m.stop, m.point, m.clause, m.article, m.key, m.doc_type, m.number, m.date, m.title, m.own) for c, m, i in pairs
            ]

        last, said = None, []
        for batch in batches:
            at, out = starts(batch), []  # where clauses begin that are not those before; what they say
            first, n = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)  # of each clause its place in that, and the number of its matches
            for k, clause in enumerate(zip(*(batch[c].take(pa.array(at)).to_pylist() for c in ("com_key", "text", "parent_text")), strict=True)):
                if clause[1]:
                    if clause != last:
                        last, said = clause, told(*clause)
                    first[k], n[k] = len(out), len(said)
                    out += said
            copies = np.diff(at, append=batch.num_rows)
            each = np.repeat(n, copies)
            rows = np.repeat(np.arange(batch.num_rows), each)
            places = np.repeat(np.repeat(first, copies) - (np.cumsum(each) - each), each) + np.arange(len(rows))
            columns = list(zip(*out, strict=True)) or [[]] * len(fields)
            texts = pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields]).take(pa.array(places))
            own = [batch[c].take(pa.array(rows)) for c in ("doc_id", "com_key")]
            yield pa.record_batch([*own, *texts.columns], names)

    doc_kind = clauses.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, com_key string, relation string, cue string, cue_start int, cue_stop int, inherited boolean, ref_start int, ref_stop int, {_REF}"
    each = clauses.select("doc_id", F.col("com_key").cast("string"), "text", "parent_text")
    return each.sortWithinPartitions(F.xxhash64("com_key", "text", "parent_text")).mapInArrow(run, schema)


def allowed(found: DataFrame, sources: DataFrame) -> DataFrame:
    """found without relations that the documents' rank rules out; citations stay. sources has doc_id and source_number.

    found is stored, since its numbers are looked up apart and the rules along the texts should run once."""
    found = stored(found, "matches")
    known = found.join(sources.select("doc_id", "source_number"), "doc_id", "left")
    itself = (F.col("number") == F.col("source_number")) & (F.col("relation") != "dan_chieu")
    judged = with_policy(known, "relation", "source_number", "number", "doc_type", sources, found)
    return judged.where(~F.col("dropped") & ~F.coalesce(itself, F.lit(False))).drop("dropped")


def decided(found: DataFrame) -> DataFrame:
    """One relation for each target of a clause: its own before inherited ones, then by priority, then the nearest cue."""
    gap = F.when(F.col("cue_stop") <= F.col("ref_start"), F.col("ref_start") - F.col("cue_stop")).otherwise(F.abs(F.col("cue_start") - F.col("ref_stop")))
    priority = F.when(F.col("inherited"), 0).otherwise(1000) + F.coalesce(mapped(F.col("relation"), RELATION_PRIORITY), F.lit(0))
    return best_relation(found, ["doc_id", "com_key", "ref_start", "ref_stop", "key"], priority, [gap, F.col("cue_start"), F.col("relation")])


def clause_kinds(docs: DataFrame, number: str, text: str) -> DataFrame:
    """docs with kind: consolidated documents and legal bases have rules of their own."""
    return docs.withColumn("kind", F.when(is_consolidated(F.col(number)), "hop_nhat").when(F.col(text).startswith("Căn cứ"), "can_cu").otherwise("generic"))


def extract_relations(clauses: DataFrame, sources: DataFrame) -> DataFrame:
    """Relations of parsed documents: clauses (doc_id, com_key, text), sources (doc_id, source_number)."""
    return decided(allowed(matched(with_parents(cleaned(clauses))), sources))
