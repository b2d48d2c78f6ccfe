"""A training-data pipeline over ``documents``: each stage is written as Parquet and read again as the next one's input.

1. language ID: documents without a language (no letters) go; short ones stay, though their cosines are small;
2. near-duplicate removal: one row of every group of near copies stays;
3. decontamination: documents that hold a passage of a benchmark item go;
4. mixing: documents are taken as often as the mix of sources takes them;
5. token files: the mix as token ids, in shards with an index, read back as one row per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import decontaminate, langid, mixing, near_dedup, token_files
from claimlake.llm.common import packed, staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a letter.  Null, empty and letterless texts go; repeated rows are judged alike; without labelled
    rows every lettered text is of an unknown language and goes; an empty table gives no rows."""
    return langid.identify(docs, given=True).filter("lang_pred <> 'und'").select("given.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is a document by itself, whatever its doc_id; of a group the one with the smallest doc_id stays (null
    last, then by a hash of the text and by place).  Texts without words are like no other, so all of them stay."""
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), packed(docs)), "numbered")
    found = near_dedup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "given.text"))
    order = F.struct(F.col("given.doc_id").isNull().alias("no_id"), "given.doc_id", F.xxhash64("given.text").alias("content"), "row")
    first = (found.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", order.alias("rank")), "row")
             .groupBy("component_id").agg(F.min("rank").alias("first")).select("first.row"))
    return rows.join(first, "row", "left_semi").select("given.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of a benchmark item.  Null and empty texts hold none; an empty benchmark keeps every row."""
    found = decontaminate.contaminated(docs.select("text", packed(docs)), table(spark, sf_dir, "benchmark"))
    return found.filter("n_items = 0").select("given.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it.  A null source is a source; texts without words are never taken."""
    return mixing.take_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per row of the mix, read back from the token files; null doc_ids come first, repeated rows each by itself."""
    return token_files.read_shards(token_files.write_shards(docs))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup_stage), ("decontamination", decontamination),
          ("mixing", mixing_stage), ("token_output", token_output)]

#: Learned, drawn and encoded: not for SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
