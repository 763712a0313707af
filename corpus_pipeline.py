"""Corpus pipeline over ``documents``: toxicity, line dedup, near-duplicate
removal, benchmark decontamination, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``; all but the last return the
columns of documents (``n_chars`` follows the text).  Nulls, empty tables,
repeated rows and extra columns are handled as the operators' docstrings say.
The result has one row per kept document: doc_id, n_tokens, ids_sha256 (of the
decimal ids joined by commas) and decoded_sha256 (of the decoded bytes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.llm import bpe, decontam, lines, minhash, subwords
from millstone.llm.common import staged, table

#: a stage needs SQL that DuckDB lacks (trained model, similarity classes)
ORACLE_SQL = None


def _with_chars(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _aside(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the whole row as ``_row``: whatever columns documents
    have, none meets a column that an operator adds."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def _back(d: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with the text that ``d`` has."""
    return _with_chars(d.select(*[(F.col("text") if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns]))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model of operator 8 does not reject."""
    model = subwords.train_toxicity(docs, table(spark, sf_dir, "labels"))
    return subwords.score_texts(_aside(docs), model).where(F.col("_score") < subwords.CUT).select("_row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of three-line windows (operator 9); documents
    that lose every line, as later exact copies do, go."""
    d = lines.dedup_lines(_aside(docs)).where("_lines_removed = 0 or _lines_removed < _lines_total")
    return _back(d, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (operator 6)."""
    return minhash.keep_one_per_class(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the benchmark's windows (operator 2)."""
    found = decontam.find_contamination(_aside(docs), table(spark, sf_dir, "benchmark"))
    return _back(decontam.remove_spans(found), docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the text decoded from them (operator 5), as digests."""
    path, pattern = bpe.multi_50k()
    d = bpe.encode(docs, path, pattern, digest=True)
    return d.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_text),
    ("bpe", encode_and_decode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
