"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid, mixing, secrets, simhash, templates
from millrace.session import cut_lineage, scratch_path, scratch_scope, table

#: A document whose most probable language is less certain than this is rejected, as is one without a language.
SURE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; null texts, texts without a letter and uncertain ones go."""
    model = langid.LanguageModel.fit(docs.filter(langid.learnable("doc_id")))
    told = model.predict(docs, pred_col="__lang", score_col="__score")
    return told.filter((F.col("__lang") != langid.UNDETERMINED) & (F.col("__score") >= SURE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, of rows with the same id the one with the smallest content hash, once."""
    # names with two underscores keep clear of the table's own columns
    marked = docs.withColumn("__row", F.xxhash64(*docs.columns))
    # the operator carries an id through, here the id with the hash that tells rows with the same id apart
    named = marked.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row").alias("name"), "text")
    groups = simhash.simhash_components(named, id_col="name")
    kept = groups.filter(F.col("name").eqNullSafe(F.col("component_id"))).groupBy("name").agg(F.count(F.lit(1)).alias("__given"))
    kept = cut_lineage(kept.select(F.col("name.doc_id").alias("__kept_id"), F.col("name.__row").alias("__kept_row"), "__given"), "kept")
    stay = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.col("__row") == F.col("__kept_row")))
    return given_once(stay, docs.columns)


def given_once(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the rows, each once; only those that were given several times (``__given``) are compared as a whole."""
    return rows.filter("__given = 1").select(*columns).unionByName(rows.filter("__given > 1").select(*columns).dropDuplicates())


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no template window with the benchmark."""
    leaks = templates.contaminations(docs, table(spark, sf_dir, "benchmark"), any_case=True)
    leaks = cut_lineage(leaks.select(F.col("doc_id").alias("__leak_id"), F.col("text_hash").alias("__leak_hash")).distinct(), "leaks")
    on = F.col("doc_id").eqNullSafe(F.col("__leak_id")) & (F.xxhash64("text") == F.col("__leak_hash"))
    return docs.join(leaks, on, "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mask and ``n_chars`` counted again where the text changed."""
    found = cut_lineage(secrets.scan(docs).select("doc_id", "text_hash", "start", "n_chars"), "secrets")
    masked = secrets.redact(docs.withColumn("__before", F.xxhash64("text")), found)
    changed = F.xxhash64("text") != F.col("__before")
    return masked.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target asks for, with ``copy`` from 1 (in place of a column of that name); documents without a copy are not in it."""
    marked = docs.withColumn("__row", F.xxhash64(*docs.columns))
    mixed = mixing.mix_sources(marked.select(F.struct("doc_id", "__row").alias("name"), "text", "source"), id_col="name")
    copies = mixed.groupBy("name").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__given")).filter("__copies > 0")
    copies = cut_lineage(copies.select(F.col("name.doc_id").alias("__id"), F.col("name.__row").alias("__own_row"), "__copies", "__given"), "copies")
    joined = marked.join(copies, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__own_row")))
    # a row that was given several times stands once for all its copies
    once = given_once(joined, [*docs.columns, "__copies"])
    columns = [c for c in docs.columns if c != "copy"]
    return once.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))).alias("copy"))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix),
]

#: The stages fit models, follow links and solve for rates; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.split()[0].lower())
        # what a stage keeps for itself goes when its rows are written
        with scratch_scope(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
    return docs
