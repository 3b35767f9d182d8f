"""The corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the columns
of documents. In run() each stage is written to the shared folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, aside, spread, table, unused
from tessera.llm.decontam import mark_benchmark
from tessera.llm.langid import UNKNOWN, held_out, predict, train
from tessera.llm.linededup import dedup_lines
from tessera.llm.mixing import domain_labels, mix
from tessera.llm.neardup import near_duplicates


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text or no letter: null, empty, or digits only) go; lang becomes the predicted one, the
    first by name of tied ones. Where no document has a lang to learn from, all stay as they are. Repeated rows are treated
    alike, and a null doc_id is like any other."""
    moved, back = aside(docs, {"lang_pred", "score"})
    model = train(docs.filter(~held_out()).select("lang", "text"))
    if not model.langs:
        return docs
    out = predict(moved, model).filter(F.col("lang_pred") != UNKNOWN)
    return out.withColumn("lang", F.col("lang_pred")).select(*back)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing but white space is left; n_chars follows the text. Documents that had
    white space only from the start stay; null texts become empty. Rows that repeat a doc_id are documents of their own, and
    all that have the largest doc_id of a line keep it; a null doc_id is below all others."""
    moved, back = aside(docs, {"n_lines", "n_dropped"})
    out = dedup_lines(moved).filter((F.col("n_dropped") == 0) | (F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != ""))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*back)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: one with the smallest doc_id, or without any if none has one; of repeated
    rows with that doc_id the first by number. Rows are numbered, and linked by number, so that null and repeated ids are
    like any others. Documents without words are in no group and stay."""
    scratch, (row,) = Scratch(spark, "rows"), unused(docs, "row")
    rows = scratch.write(docs.withColumn(row, F.monotonically_increasing_id()))
    found = near_duplicates(spread(rows), row).filter("n_shingles > 0").select(F.col("doc_id").alias(row), "component_id")
    found = scratch.write(found.join(rows.select(row, F.col("doc_id").cast("long").alias("id")), row))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col(row).alias("number")))
    stay = found.groupBy("component_id").agg(first.alias("m")).select(F.col("m.number").alias(row))
    return rows.join(found.join(stay, row, "left_anti").select(row), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go, whatever their ids; null and empty texts have none and stay."""
    moved, back = aside(docs, {"n_words", "hits", "items"})
    return mark_benchmark(moved, table(spark, sf_dir, "benchmark")).filter(F.size("hits") == 0).select(*back)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with n_tokens, domain, rate and copies, which replace columns of these names; those with no copy in the
    mix go, among them all that are likeliest toxic. A rate is rounded by a hash of the doc_id: rows that repeat one, or have
    none, are rounded alike. Without labels every document has one copy."""
    out = mix(docs, domain_labels(table(spark, sf_dir, "labels"))).filter(F.col("copies") > 0)
    new = ["n_tokens", "domain", "rate", "copies"]
    return out.select(*[c for c in docs.columns if c.lower() not in {*new, "posterior"}], *new)


STAGES = [("language", language), ("lines", lines), ("near", near), ("decontaminate", decontaminate), ("mixing", mixing)]
#: Language ID, MinHash candidates and the fitted mix aren't SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spread(table(spark, sf_dir, "documents")), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = spread(scratch.write(stage(spark, docs, sf_dir)))
    return STAGES[-1][1](spark, docs, sf_dir)
