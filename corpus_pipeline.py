"""The corpus pipeline: five stages over ``documents``, each reading what the one before has written.

Bad texts go first, then all but one of each group of near copies, then passages repeated across documents, then
documents that hold a window of the benchmark; what is left is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import contamination, jaccard, packing, quality, substrings
from tidewheel.llm.tables import read, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the quality classifier, learned from ``labels``, does not reject."""
    return quality.accepted(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest doc_id, and the first of these as rows were written.

    Rows are told apart by a number of their own, so rows that repeat a doc_id are compared like others, and so are
    rows without one, which come last within a group.
    """
    row = "__row" + "_" * max(map(len, docs.columns))  # a name no column has
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = jaccard.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    # written: three tables are made from it, and the plan behind it is long
    groups = stored(found.where("n_links > 0").select(F.col("doc_id").alias("row"), "class_id"), "groups")
    ranked = groups.join(rows.select(F.col(row).alias("row"), "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    kept = ranked.groupBy("class_id").agg(first).select(F.col("first.row").alias("kept"))
    gone = groups.join(kept, F.col("row") == F.col("kept"), "left_anti").select(F.col("row").alias("gone"))
    return rows.join(gone, F.col(row) == F.col("gone"), "left_anti").drop(row)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that earlier passages repeat; texts left without a word go."""
    cut = substrings.remove_repeats(docs).where("n_removed = 0 OR n_removed < n_words")
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast(docs.schema["n_chars"].dataType)}
    changed["n_chars"] = F.when(F.col("n_removed") > 0, changed["n_chars"]).otherwise(F.col("n_chars"))
    return cut.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that hold no window of the benchmark."""
    return contamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, by number and check sum of their ids."""
    return packing.packed(docs, ids=False, tokens=packing.model_tokenizer)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", drop_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: Neither the classifier nor the tokens can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written as Parquet before the next."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
