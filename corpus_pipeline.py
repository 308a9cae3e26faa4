"""Corpus pipeline: quality rules, near-duplicate removal, repeated-passage removal, benchmark
decontamination and source mixing, each stage on all that the one before has kept.

``run`` writes every stage as Parquet below the cluster's shared checkpoint folder and reads it
again, so a lost executor costs one stage's tasks at most. Rows are matched by id and a digest of
the text (a stage's verdicts are small tables beside the texts), NULL ids match NULL ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylab.llm import decontam, fertility, mixing, simhash, suffix
from delaylab.llm._common import cut, read_table
from delaylab.operators._plan import MAX_BROADCAST_BYTES, measured_bytes
from delaylab.session import scratch_path

# The tokeniser measures, the bands taken from the corpus and the seeded choices have no SQL form.
ORACLE_SQL = None


def _match(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` that have a verdict (``left_semi``), or each with its verdict's further
    columns (``inner``; columns of ``docs`` with their names give way to them).
    ``verdicts(doc_id, _key, ...)`` are broadcast if their measured size allows. Rows travel as one
    struct, so no column name can clash."""
    more = [c for c in verdicts.columns if c not in ("doc_id", "_key")]
    verdicts = cut(verdicts.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_digest"),
                                   F.struct(F.lit(True), *more).alias("_verdict")))
    if measured_bytes(verdicts) <= MAX_BROADCAST_BYTES:
        verdicts = F.broadcast(verdicts)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
                         docs["doc_id"].alias("_own"), F.xxhash64(docs["text"]).alias("_text"))
    same = packed["_own"].eqNullSafe(verdicts["_id"]) & (packed["_text"] == verdicts["_digest"])
    kept = packed.join(verdicts, same, how)
    if how == "left_semi":
        more = []
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in more],
                       *[F.col("_verdict")[c].alias(c) for c in more])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; without a column ``lang`` all are judged by script."""
    rules = fertility.quality_rules(docs, lang_col="lang" if "lang" in docs.columns else None)
    return _match(docs, rules.where("kept").select("doc_id", "_key").distinct(), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id (documents without
    an id come last), of those that share it the one with the smallest text digest; of a repeated
    row one stays. Every group keeps one, whatever ids its documents have."""
    classes = simhash.simhash_classes(docs)
    rows = classes.groupBy("root", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key", "n")).alias("f")
    picked = cut(rows.groupBy("root").agg(first).select(
        F.col("f.doc_id").alias("doc_id"), F.col("f.key").alias("_key"), F.col("f.n").alias("n")))
    kept = _match(docs, picked.select("doc_id", "_key"), "left_semi")
    if picked.where("n > 1").isEmpty():
        return kept
    return kept.dropDuplicates(["doc_id", "text"])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without their repeated passages; n_chars follows the text."""
    done = suffix.remove_repeats(docs, into="_repeats")
    text = F.when(F.col("_repeats.n_removed") > 0, F.col("_repeats.text")).otherwise(F.col("text"))
    done = done.withColumn("text", text)
    if "n_chars" in docs.columns:
        chars = F.when(F.col("_repeats.n_removed") > 0, F.length("text").cast("long"))
        done = done.withColumn("n_chars", F.coalesce(chars, F.col("n_chars")))
    return done.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark has not contaminated."""
    found = decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    clean = found.where("not contaminated").select("doc_id", "_key").distinct()
    return _match(docs, clean, "left_semi")


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target and taken (words taken,
    repeats counted; columns of these names in ``docs`` give way to them)."""
    mixed = mixing.mix(docs).where("taken > 0")
    mixed = mixed.groupBy("doc_id", "_key").agg(
        *[F.max(c).alias(c) for c in ("size", "source_size", "target", "taken")])
    return _match(docs, mixed, "inner")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", target_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
