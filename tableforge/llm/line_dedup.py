"""Exact line deduplication by range-partitioned hashes.

Lines of at least ``min_chars`` code points become rows of hash, document and
position. These are range-partitioned by hash and document, so the rows of a hash that
fills a third of the corpus lie in many tasks, and each task sorts its rows by hash, document
and position. The first row of each run of a document is its first occurrence of the line;
these are streamed into a count of documents and the last of them by hash, a row for each
hash and task. The result goes back as a bitmap for each document, in words of 64 lines
of which those without a dropped line are left out. The rows of lines hold no text; texts are
shuffled once, with the other columns, to meet their bitmaps.

Null and empty texts are one empty line. Documents are told apart by ``doc_id`` (null is
one document too); rows that share an id count once and are each filtered by their own
lines. Extra columns are kept; a helper column never takes a name that is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableforge.llm.common import BLANKS, UPPER, ascii_lower, documents, whole_text, written

MIN_CHARS = 40
MIN_DOCUMENTS = 5


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row for each long line: two hashes of its key, document, text hash, position."""
    text = whole_text(F.col("text"))
    lines = docs.select(
        "doc_id",
        F.hash(text).alias("text_hash"),
        F.posexplode(F.split(ascii_lower(text), "\n", -1)).alias("pos", "line"),
    )
    keys = lines.withColumn("line", F.btrim("line", F.lit(BLANKS)))
    return keys.where(F.length("line") >= min_chars).select(
        F.xxhash64("line").alias("key"),
        F.hash("line").alias("key2"),
        "doc_id",
        "text_hash",
        "pos",
    )


def repeated_lines(occurrences: DataFrame, min_documents: int) -> DataFrame:
    """Keys found in at least ``min_documents`` documents, with the largest ``doc_id``."""
    keys = ["key", "key2"]
    ranged = occurrences.select(*keys, "doc_id", "pos").repartitionByRange(*keys, "doc_id")
    # A range of (key, document) holds all rows of a pair: one sort, no further shuffle here.
    run = Window.partitionBy(*keys, "doc_id").orderBy("pos")
    firsts = ranged.withColumn("nth", F.row_number().over(run)).where("nth = 1")
    runs = firsts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("owner"))
    return runs.where(F.col("n") >= min_documents).select(*keys, "owner")


def dropped_line_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``doc_id, text_hash, dropped``: a map from word number to the 64 lines in it.

    Documents and words without a dropped line are absent; the set bits are dropped.
    """
    found = written(_occurrences(docs, min_chars), "lines")
    # As a table of its own, the join reads both sides from shuffles and can split a hot key.
    owners = written(repeated_lines(found, min_documents), "owners")
    lost = found.join(owners, ["key", "key2"]).where(~F.col("doc_id").eqNullSafe(F.col("owner")))
    words = lost.groupBy("doc_id", "text_hash", (F.expr("pos div 64").cast("int")).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")
    )
    return words.groupBy("doc_id", "text_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped")
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``docs`` with three further columns: ``n_lines``, ``n_dropped`` and ``kept_text``.

    A column of ``docs`` with one of these names is replaced.
    """
    marks = dropped_line_bitmaps(docs, min_chars, min_documents).select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "dropped"
    )
    text = whole_text(F.col("text"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text.alias("body"))
    joined = rows.join(
        marks,
        F.col("id").eqNullSafe(F.col("__doc")) & (F.hash("body") == F.col("__hash")),
        "left",
    )
    kept = F.expr(
        "array_join(filter(split(body, '\\n', -1), (line, i) -> "
        "(shiftright(coalesce(dropped[i div 64], 0L), i % 64) & 1L) = 0), '\\n')"
    )
    n_dropped = F.expr("aggregate(map_values(dropped), 0L, (n, bits) -> n + bit_count(bits))")
    n_lines = F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) + 1
    named = {
        "n_lines": n_lines.cast("long"),
        "n_dropped": F.coalesce(n_dropped, F.lit(0)).cast("long"),
        "kept_text": F.when(F.col("dropped").isNull(), F.col("body")).otherwise(kept),
    }
    others = [F.col("row")[name].alias(name) for name in docs.columns if name.lower() not in named]
    return joined.select(*others, *[value.alias(name) for name, value in named.items()])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{UPPER}', '{UPPER.lower()}') AS key FROM lines
), owners AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}
), marked AS (
  SELECT doc_id, pos, line, owner IS NOT NULL AND owner <> doc_id AS lost
  FROM keyed LEFT JOIN owners USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
