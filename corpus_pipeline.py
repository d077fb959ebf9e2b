"""A pipeline over ``documents``: quality, line dedup, near duplicates, test items, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``docs``. A document whose text
changes gets its ``n_chars`` anew, if it has that column.

Null and empty texts go with the quality stage. The near duplicates and the test
items are told by a row's id and text together, so every row is judged by its own
text: rows without an id as well, and different texts of one id each for itself.
Rows equal in id and text are one row from the near duplicates on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.llm.common import cut, table, with_ids, without_ids
from parcelscope.llm.decontaminate import contaminated
from parcelscope.llm.jaccard_join import near_duplicates
from parcelscope.llm.line_templates import drop_recurring_lines
from parcelscope.llm.packing import pack
from parcelscope.llm.quality import keep_good

#: The column of a row's key within a stage.
KEY = "_row_key"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines of recurring templates, and lines equal in two texts, from the texts."""
    out = drop_recurring_lines(docs, exact=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of its rows, from id and text: never null."""
    return docs.withColumn(KEY, F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one of the smallest
    id, then key; one with an id before those without."""
    rows = keyed(docs)
    of = (near_duplicates(rows, id_col=KEY).groupBy(F.col("doc_id").alias(KEY))
          .agg(F.count("*").alias("rows"), F.min("component_id").alias("component_id")))
    ids = rows.groupBy(KEY).agg(F.min("doc_id").alias("doc_id"))
    of = cut(of.join(ids, KEY), "pipeline-components")
    first = (of.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", KEY)).alias("f"))
             .select(F.col(f"f.{KEY}").alias(KEY)))
    stay = of.join(first, KEY, "left_semi")
    again = cut(stay.filter("rows > 1").select(KEY), "pipeline-repeated")
    listed = cut(of.join(first, KEY, "left_anti").select(KEY).union(again), "pipeline-ids")
    return without_ids(rows, listed, KEY).union(with_ids(rows, again, KEY).dropDuplicates([KEY])).drop(KEY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a test item or an edited copy of one."""
    rows = keyed(docs)
    found = contaminated(rows, table(spark, sf_dir, "benchmark"), id_col=KEY)
    found = cut(found.select(F.col("doc_id").alias(KEY)).distinct(), "pipeline-found")
    return without_ids(rows, found, KEY).drop(KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicate),
          ("benchmark decontamination", decontamination), ("packing", packing)]

#: Stages learn, hash and tokenize; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = cut(out, "pipeline-" + name.split()[0].lower())
    return docs
