"""A training-data pipeline over ``documents``: five stages, each on all that the one before kept.

    language   compression classification; what it rejects goes
    toxicity   n-gram classifier; what it calls toxic goes
    exact      content sort; one document of each group of equal texts stays
    near       Jaccard join on five-word shingles at 0.8; the smallest id of each component stays
    pack       sequences of 1024 ids; the only stage whose rows are not documents

Each stage is written as Parquet under the shared folder of ``spark.checkpoint.dir`` and read again.
All columns of the input are kept to the last stage, whatever their names; columns that a stage adds for
itself have names that no column begins with.  An empty table passes through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantsilo.llm import content_sort, langid_zstd, ngram_join, packing, toxicity
from quantsilo.llm.common import fold, free, quoted, table
from quantsilo.session import ensure_checkpoint_dir

#: Stages after the first cannot be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def _own(docs: DataFrame) -> str:
    """What the names of columns that a stage adds for itself begin with."""
    return free("__stage_", docs.columns)


def _without(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*map(quoted, docs.columns))


def _key(col: str):
    """An id as text that is never null, so that a join on it keeps its partitioning."""
    return F.when(F.col(col).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(col).cast("string")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; learns from those whose crc32 modulo 4 is not 2.

    Null and empty texts and texts without a letter are rejected, and all are when nothing can be learnt.
    Rows that repeat an id or a text are decided each by its text, so alike.
    """
    own = _own(docs)
    model = langid_zstd.train(docs, fold("doc_id", 4) != 2)
    out = langid_zstd.classify(docs, model, keep=tuple(docs.columns), prefix=own)
    return _without(out.where(~F.col(f"{own}rejected")), docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; learns from labels of documents whose crc32 modulo 5 is not 0.

    Null texts count as empty; without labels to learn from every document stays.  Rows that repeat an id
    or a text are decided each by its text, so alike.
    """
    own = _own(docs)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    out = toxicity.score(docs, model, keep=tuple(docs.columns), prefix=own)
    return _without(out.where(F.col(f"{own}predicted") == 0), docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts equal but for white space: the longest, then the smallest id.

    Rows that repeat an id and a text are one group, of which one row stays.
    """
    own = _own(docs)
    found = content_sort.content_sort(docs)
    kept = found.where("kept").select(_key("doc_id").alias(f"{own}id"), F.col("text_sha256").alias(f"{own}sha"),
                                      F.col("n_chars").alias(f"{own}kept_chars"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumns({
        f"{own}id": _key("doc_id"), f"{own}chars": F.length(text),
        f"{own}sha": F.sha2(F.regexp_replace(text, content_sort.SPACES, ""), 256)})
    keys = [f"{own}id", f"{own}sha"]
    one = rows.join(kept, keys).where(F.col(f"{own}chars") == F.col(f"{own}kept_chars")).dropDuplicates(keys)
    return _without(one, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component, ids that are null last.

    Rows that repeat an id are told apart by their texts; those that repeat both stay or go together.
    """
    own = _own(docs)
    # ids as one value that orders like the id, with the text's digest behind it
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                   F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("sha"))
    found = ngram_join.jaccard_components(docs.select(row.alias("row"), "text"), words=5, num=80, den=100, id_col="row")
    kept = found.where("row = component_id").select(F.col("row").alias(f"{own}row")).distinct()
    return _without(docs.withColumn(f"{own}row", row).join(kept, f"{own}row", "left_semi"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids; a null text counts as empty, repeated rows count each."""
    return packing.pack(docs)


STAGES = [("language", language), ("toxicity", not_toxic), ("exact", exact), ("near", near), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
