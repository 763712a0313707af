"""Operator 9: line dedup over overlapping three-line windows (columns only).

Every run of three consecutive lines is a window, known by two 64-bit hashes.
Of the windows with equal lines the first by (doc_id, position) stays; each
line that a later one covers is removed.  Windows are judged on the input.

Defined cases: NULL text has no lines and stays NULL; an empty text is one
empty line; texts of fewer than three lines have no window; windows of blank
lines only do not count; rows with equal doc_id and text are the same
occurrence (neither removes from the other); a NULL doc_id sorts first; other
columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.llm.common import table

WINDOW = 3


def _lines(text_col: str):
    return F.split(F.col(text_col), "\n", -1)


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rk1, rk2, doc, pos, w1, w2): one row per window, texts left behind."""
    d = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("t"))
    d = d.where("t is not null").select(
        "doc", F.xxhash64("doc", "t").alias("rk1"), F.xxhash64(F.lit("~"), "doc", "t").alias("rk2"),
        F.transform(_lines("t"), lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit("~"), x).alias("b"),
            (F.trim(x) == "").alias("blank"))).alias("h"))
    d = d.where(F.size("h") >= WINDOW)
    w = d.select("doc", "rk1", "rk2", F.explode(F.expr(f"""
        transform(sequence(0, size(h) - {WINDOW}), i -> struct(i AS pos,
            xxhash64(h[i].a, h[i + 1].a, h[i + 2].a) AS w1, xxhash64(h[i].b, h[i + 1].b, h[i + 2].b) AS w2,
            h[i].blank AND h[i + 1].blank AND h[i + 2].blank AS blank))""")).alias("w"))
    return w.where("not w.blank").select("rk1", "rk2", "doc", "w.pos", "w.w1", "w.w2")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``text_col`` after removal, plus
    ``_lines_total`` and ``_lines_removed`` (long; 0 and 0 for NULL text)."""
    w = line_windows(docs, id_col, text_col)
    first = (w.groupBy("w1", "w2").agg(F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    later = w.join(first, ["w1", "w2"]).where(F.struct("doc", "pos") > F.col("first"))
    gone = later.groupBy("rk1", "rk2").agg(F.collect_set("pos").alias("p")).select(
        "rk1", "rk2", F.expr("array_distinct(flatten(transform(p, i -> array(i, i + 1, i + 2))))").alias("gone"))
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                    F.xxhash64(id_col, text_col).alias("rk1"),
                    F.xxhash64(F.lit("~"), id_col, text_col).alias("rk2"))
    d = d.join(gone, ["rk1", "rk2"], "left")
    d = d.withColumn("lines", F.split(F.col("row")[text_col], "\n", -1))
    kept = F.expr("array_except(sequence(0, size(lines) - 1), gone)")
    text = (F.when(F.col("gone").isNull(), F.col("row")[text_col])
            .otherwise(F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n")))
    return d.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in cols],
                    F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("_lines_total"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_lines_removed"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed lines and a digest of the kept text."""
    d = dedup_lines(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.col("_lines_total").alias("n_lines"), F.col("_lines_removed").alias("n_removed"),
                    F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


LINES_CTE = """
l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {docs}),
w AS (SELECT doc_id, i, ls[i + 1 : i + 3] AS k FROM (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS i FROM l)
      WHERE trim(ls[i + 1]) <> '' OR trim(ls[i + 2]) <> '' OR trim(ls[i + 3]) <> ''),
g AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS rn FROM w) WHERE rn > 1),
x AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS i FROM l),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM x ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
"""

OP9_SQL = "WITH " + LINES_CTE.format(docs="documents") + """
SELECT d.doc_id, coalesce(len(l.ls), 0)::BIGINT AS n_lines, coalesce(n.n, 0)::BIGINT AS n_removed,
       length(coalesce(kept.t, ''))::BIGINT AS kept_chars, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id) n USING (doc_id)
"""
