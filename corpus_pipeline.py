"""Corpus pipeline: documents to tokens in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read back as the next one's ``docs``. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontamination, language_id, line_dedup, ngram_join
from ledgerline.llm.common import column, free_name, staged, table
from ledgerline.llm.queries import WORD_BPE


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those without a letter (``und``) and those unlike the language told go, however they are labelled."""
    model = language_id.train_split(spark, docs)
    name = free_name(docs, "__language")
    told = docs.withColumn(name, language_id.predictor(spark, model)(docs["text"]))
    return told.where(F.col(f"{name}.lang_pred") != language_id.UNDETERMINED).where(~F.col(f"{name}.unlike")).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a later document keeps; every document stays."""
    name = free_name(docs, "__lines")
    done = line_dedup.dedup_lines(spark, docs, name=name)
    return done.select(*[_with_text(docs, c, F.col(f"{name}.kept")) for c in docs.columns])


def _with_text(docs: DataFrame, c: str, text):
    """The column ``c``, or the new text in its place; n_chars follows the text."""
    if c == "text":
        return F.when(docs["text"].isNull(), docs["text"]).otherwise(text).alias(c)
    if c == "n_chars":
        return F.char_length(text).cast(docs.schema[c].dataType).alias(c)
    return column(docs, c)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id."""
    return ngram_join.first_of_groups(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    name = free_name(docs, "__hits")
    found = decontamination.with_hits(spark, docs, table(spark, sf_dir, "benchmark"), name)
    return found.where(F.col(f"{name}.n_hit") == 0).drop(name)


#: Words that a task of the last stage holds at a time: fewer than by default, as its workers come from four stages before.
CHUNK_WORDS = 400_000


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids and decoded text of every document that is left."""
    return bpe.encode_texts(spark, docs, WORD_BPE, most=CHUNK_WORDS)


STAGES = [("language_id", keep_known_language), ("line_dedup", drop_repeated_lines), ("ngram_join", keep_one_of_near_copies),
          ("decontamination", drop_contaminated), ("bpe", encode)]

#: SQL has no n-gram classifier and no BPE; tests/llm holds run() against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
