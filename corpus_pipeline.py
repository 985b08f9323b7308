"""A cleaning, mixing and packing pipeline for a corpus; each stage calls one operator of
starmill.llm.

Every stage takes the documents its predecessor kept and reads only the columns of documents,
whatever others there are. Where ids are missing or repeated, rows are numbered as they are
read, and the numbers stand for the ids inside the stage; such rows are documents of their own.
An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import ready, table
from starmill.llm.langid import identify
from starmill.llm.mixing import mix, take_words
from starmill.llm.packing import pack
from starmill.llm.simhash import near_duplicates
from starmill.llm.suffixes import remove_repeats
from starmill.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of documents and ``row``, which is the id if ids tell all rows apart."""
    ready(spark)
    docs = docs.select(COLUMNS)
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn("row", F.col("doc_id"))
    return stage(docs.withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents whose language is rejected: texts without a letter, null and empty
    ones, and texts unlike all languages learned. Null languages get the predicted one."""
    docs = numbered(spark, docs)
    found = identify(docs, id_col="row").where("not rejected")
    kept = docs.join(found.select(F.col("doc_id").alias("row"), "lang_pred"), "row")
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    docs = numbered(spark, docs)
    found = near_duplicates(docs, id_col="row").where("doc_id = component_id")
    kept = docs.join(found.select(F.col("doc_id").alias("row")), "row", "left_semi")
    return kept.select(COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur in a document with a smaller id are cut out; what is left of a text,
    be it empty, stays. Characters of which only some bytes are cut go as a whole."""
    docs = numbered(spark, docs)
    cut = remove_repeats(docs, id_col="row", carry=["doc_id", "lang", "source"])
    return cut.select(
        "carried.doc_id",
        F.col("kept").alias("text"),
        "carried.lang",
        "carried.source",
        F.char_length("kept").cast("long").alias("n_chars"),
    )


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each document the words that the mix takes stay, twice if it takes them twice;
    documents of which it takes none go."""
    docs = numbered(spark, docs)
    taken = mix(docs, id_col="row").where("taken > 0")
    mixed = docs.join(taken.select(F.col("doc_id").alias("row"), "size", "taken"), "row")
    mixed = take_words(mixed, "text", "size", "taken")
    return mixed.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    import public_tokenizers

    ready(spark)
    return pack(docs.select(COLUMNS), public_tokenizers.path("byte_bpe_50k.json"), added=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Models, fingerprints and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
