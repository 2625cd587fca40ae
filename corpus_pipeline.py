"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``. ``run`` applies them to the whole table.

Nulls and odd rows: a null text is an empty one and fails the quality rules. Rows with a
null doc_id can't be told apart, so near-dedup lets them pass. Rows of one doc_id and one text
become one at near-dedup; different texts of one id all stay where that id stays. Very
long texts are handled whole, ties go to the smallest doc_id. An empty table passes every
stage. Extra columns are kept as they are by the first four stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colsink.llm.common import Scratch, n_words, read_table
from colsink.llm.mixing import mix
from colsink.llm.near_dup import NearDup, near_dup
from colsink.llm.packing import pack, token_pieces
from colsink.llm.pii import redact
from colsink.llm.quality import clean
from colsink.llm.secret_scan import mask_secrets
from colsink.llm.tokenizing import WORD_BPE, vocabulary

#: The query has no SQL form: near-dedup's components and the packing program are iterative.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a text has changed."""
    length: Column = F.length("text").cast("long")
    return docs.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that break the rules are removed; documents that fail go."""
    return _sized(clean(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group at 80% of five-word shingles, the document of smallest id stays."""
    kept = near_dup(docs, NearDup(width=5, percent=80)).where("doc_id = component_id").select("doc_id").distinct()
    # rows of one id and one text are one document; other texts of that id are documents of their own
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    known = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(row).alias("_row")).select("_row.*")
    return known.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed spans of personal data and secrets are masked; every document stays."""
    plain = redact(docs)
    return _sized(plain.withColumn("text", mask_secrets(plain["text"])))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources take their target shares of all words: rows are repeated or left out."""
    names = docs.columns
    at = "_size"
    while at in names:
        at = f"_{at}"
    mixed = mix(docs.withColumn(at, n_words(docs["text"])), size=at)
    return mixed.where("copies > 0").select(*names, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(f"{at}_copy")).select(*names)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents placed in sequences of at most 2048."""
    pieces = Scratch(spark, "pipeline-pack").keep(token_pieces(docs, vocabulary(WORD_BPE)), "pieces")
    return pack(pieces, ["doc_id", "piece", "start"])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is written to the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = scratch.keep(docs, name)
    return docs
