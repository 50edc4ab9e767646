"""Line deduplication over the corpus with DataFrame functions only.

Lines are exploded, normalised and hashed; the distinct documents of each
hash are counted; lines of frequent hashes go and the others are joined
again by position. Line texts never enter a shuffle one by one: only 16-byte
hashes with (document, position) do, and each document travels once, as its
array of lines, to meet the positions it loses. A line that fills a third of
the corpus is pre-aggregated before its count is shuffled, and the semi join
against the written table of frequent hashes is either a broadcast that
Spark sizes itself or a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flotilla.llm.shared import ascii_lower
from flotilla.session import cut_lineage

#: Characters stripped at both ends of a line.
LINE_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The normalised form under which lines are counted."""
    return ascii_lower(F.trim(line, F.lit(LINE_SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _base(docs: DataFrame, text_col: str, id_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("t1"),
                       F.xxhash64(F.lit("text"), text).alias("t2"), _lines(F.col(f"`{text_col}`")).alias("lines"), *more)


def keyed_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 1) -> DataFrame:
    """(id, t1, t2, pos, h1, h2): one row per line whose key has ``min_chars``
    code points; t1, t2 hash the document's text and h1, h2 the line's key."""
    return (_base(docs, text_col, id_col)
            .select("id", "t1", "t2", F.posexplode("lines").alias("pos", "line"))
            .withColumn("key", line_key(F.col("line")))
            .filter(F.char_length("key") >= min_chars)
            .select("id", "t1", "t2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")))


def line_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop every line whose key occurs in at least ``min_docs`` documents.

    Returns ``row`` (all input columns, the text replaced by the lines kept,
    joined by a newline), ``n_lines`` and ``n_dropped``, one row per input row.

    - Null or empty text is one empty line, kept as the empty text; a text
      that loses all its lines becomes empty. No row is dropped.
    - Documents are counted by distinct non-null id: rows repeated under one
      id count once, rows without an id lose frequent lines but don't count.
    - Rows that share an id are judged by their own texts.
    - Other columns, whatever their names, are carried in ``row``.
    """
    lines = keyed_lines(docs, text_col, id_col, min_chars)
    frequent = cut_lineage(lines.groupBy("h1", "h2").agg(F.countDistinct("id").alias("n"))
                           .filter(F.col("n") >= min_docs).select("h1", "h2"), "frequent-lines")
    drops = (lines.join(frequent, ["h1", "h2"], "left_semi")
             .groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("pos")))
    rest = [c for c in docs.columns if c != text_col]
    base = _base(docs, text_col, id_col, F.struct(*[F.col(f"`{c}`").alias(c) for c in rest]).alias("rest"))
    joined = base.alias("b").join(
        drops.alias("d"), F.col("b.id").eqNullSafe(F.col("d.id")) & (F.col("b.t1") == F.col("d.t1")) & (F.col("b.t2") == F.col("d.t2")),
        "left").select("b.rest", "b.lines", F.col("d.pos").alias("drop"))
    index = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.transform(index, lambda i: F.col("lines")[i]))
    out = joined.select("rest", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    text = F.array_join("kept", "\n")
    row = F.struct(*[(text if c == text_col else F.col("rest")[c]).alias(c) for c in docs.columns])
    return out.select(row.alias("row"), "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"))
