"""Queries of the text problems over the driver's tables (names pN_...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrickflow.llm import mixing, packing, quality, tokens
from derrickflow.session import materialise
from derrickflow.sources.telemetry import table


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _items(spark: SparkSession, folder: str) -> DataFrame:
    same = F.when(F.length(F.trim("text")) > 0, F.xxhash64(F.lower(F.regexp_replace(F.trim("text"), r"\s+", " "))))
    docs = _documents(spark, folder).select("doc_id", "text", "source", "duplicate_of", same.alias("cluster"))
    return materialise(tokens.sized(docs), "sizes")


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_items(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that the packing had to cut."""
    return _packed(spark, folder).where("piece > 0").select("doc_id").distinct()


def p7_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences, their tokens and fill."""
    seqs = _packed(spark, folder).where("sequence is not null").groupBy("sequence").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("n"))
    return seqs.agg(F.count("*").alias("n_sequences"), F.sum("n").alias("n_pieces"), F.sum("used").alias("n_tokens"), F.max("used").alias("fullest"), (F.sum("used") / F.count("*") / packing.CAPACITY).alias("fill"))


def p7_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The sequence of every document."""
    return _packed(spark, folder)


def p7_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of texts of one group that had to share a sequence."""
    docs = _items(spark, folder)
    return packing.conflicts(packing.pack(docs), docs)


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs = materialise(tokens.sized(_documents(spark, folder).select("doc_id", "text", "source")), "sizes")
    return docs, mixing.weights(docs, table(spark, folder, "mix_targets"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Target sources that fall short of their share in the written mix, though all their documents are in it as often as allowed."""
    docs, plan = _mix(spark, folder)
    return mixing.shortfalls(materialise(mixing.realise(docs, plan), "mix"), docs, plan).select("source")


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix: how often every document is drawn."""
    return mixing.realise(*_mix(spark, folder))


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of every target source."""
    docs, plan = _mix(spark, folder)
    return mixing.report(mixing.realise(docs, plan), plan)


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    frequent = quality.frequent_words(table(spark, folder, "common_words"))
    stats = materialise(quality.measured(_documents(spark, folder).select("doc_id", "text"), frequent), "stats")
    return quality.judged(stats, quality.fit_prose(stats))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Outliers from the prose of their language."""
    return _judged(spark, folder).where("outlier").select("doc_id")


def p9_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics, distance and contributions of every document."""
    return _judged(spark, folder)


def p9_labels(spark: SparkSession, folder: str) -> DataFrame:
    """How readers' labels agree with the verdict: documents per label and verdict."""
    found = _judged(spark, folder).select("doc_id", F.col("outlier").alias("found"))
    return table(spark, folder, "doc_labels").join(found, "doc_id").groupBy("label", "found").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (p7_found, p7_sequences, p7_packed, p7_conflicts, p8_found, p8_mix, p8_shares, p9_found, p9_statistics, p9_labels)}
#: Token sizes and text statistics have no SQL; these queries are tested against brute force.
SQL: dict[str, str] = {}
