"""From raw documents to token ids: toxicity, near copies, benchmark leaks, personal data, encoding.

STAGES are applied in order; each result is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``, and each works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm._store import Store, table
from lexspark.llm.decontaminate import remove_contaminated
from lexspark.llm.jaccard_join import jaccard_components
from lexspark.llm.pii import redact_documents
from lexspark.llm.sentencepiece import encode_and_check, read_model
from lexspark.llm.toxicity import fit_chain, score_chain


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go. Null and empty texts have no words and stay."""
    chain = fit_chain(docs, table(spark, sf_dir, "labels"))
    return score_chain(docs, chain).where(F.coalesce("p_toxic", F.lit(0.0)) < chain.thresholds[-1]).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by Jaccard similarity (five words, 0.8 or more) the smallest doc_id stays.

    Empty texts link with nothing and stay, as do rows without a doc_id. Of rows that repeat a doc_id the
    one with the least text stays, found by an aggregate that is combined before it is shuffled.
    """
    groups = jaccard_components(docs, words=5, percent=80)
    copies = groups.where("component_id != doc_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(F.struct(*docs.columns), "text").alias("_row"), F.first(F.struct(*docs.columns)).alias("_any"))
    named = named.join(copies, F.col("_id") == F.col("doc_id"), "left_anti").select(F.coalesce("_row", "_any").alias("_row")).select("_row.*")
    return named.unionByName(docs.where("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to edits, go; each row is judged by its own text."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to its kind in brackets; no document goes."""
    return redact_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each text, and whether they decode to it."""
    out = encode_and_check(docs, read_model())
    return out.select("doc_id", "lang", "source", "n_chars", F.size("ids").alias("n_ids"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("personal_data", hide_personal_data),
    ("sentencepiece", encode),
]

#: Classifiers, locality-sensitive hashing and tokenising have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    store = Store(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
