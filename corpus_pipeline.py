"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.llm import langid, linededup, mixing, packing, simhash
from meterline.llm.common import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# Documents below this nearness to every language are rejected, and those
# without any letter.  Profiles share about half their n-grams with any prose.
MIN_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that some language's profile is near to, those
    without an id, too."""
    rows = docs.select(F.monotonically_increasing_id().alias("doc_id"), F.col("doc_id").alias("id"), *COLUMNS[1:])
    found = langid.identify(rows, langid.learn_profiles(docs), keep=("id", *COLUMNS[1:]))
    return (found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
            .select(F.col("id").alias("doc_id"), *COLUMNS[1:]))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring line templates; documents left without a word go."""
    kept = linededup.drop_recurring_lines(docs)
    return (kept.filter((F.col("n_dropped") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
            .select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                    F.length("kept_text").cast("long").alias("n_chars")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group, the first by doc_id and then by content.
    Rows are judged by their own text: different texts of one id stay apart."""
    content = F.xxhash64(*COLUMNS)
    rows = staged(docs.select(*COLUMNS, content.alias("content")).withColumn("row", F.monotonically_increasing_id()), "pipeline-numbered")
    groups = simhash.simhash_components(rows.select(F.col("row").alias("doc_id"), "text"), shingle=3, max_bits=2)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content", "row")
    first = (groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id", "content"), "row")
             .groupBy("component_id").agg(F.min(order)["row"].alias("row")))
    return rows.join(first, "row", "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each row as the mix takes; ids stay.  Rows are drawn by
    their content, so a rerun draws the same, and joined by their number, so
    texts that share an id, and those without one, are taken each on its own."""
    rows = staged(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "pipeline-drawn")
    drawn = rows.select(F.xxhash64(*COLUMNS).alias("doc_id"), "text", "source", "row")
    copies = mixing.mix(drawn, keep=("row",)).filter("copies > 0").select("row", "copies")
    return (rows.join(copies, "row").select(*COLUMNS, F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
            .select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences: one row per piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

# Fingerprints, cube sampling and a tokenizer have no SQL form; tests/llm holds
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
