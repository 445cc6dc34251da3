"""The corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written and read again as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselorn.llm import linededup, mixing, nearsets, pieces, quality
from tesselorn.llm.common import remainder, written
from tesselorn.llm.queries import TARGETS, label_domains

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Stands for a null id in joins: behind all others.
LAST = (1 << 63) - 1


def _rows(docs: DataFrame) -> DataFrame:
    """The columns of documents with a key of each row, which a null id also has."""
    return docs.select(*COLUMNS, F.coalesce("doc_id", F.lit(LAST)).alias("_id"), F.xxhash64("text").alias("_hash"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below 0.3 go. Labels are
    learnt from ids whose crc32 mod 5 is not 0; without any label all documents
    score 0.5 and stay. Null texts are scored as empty. Repeated rows are scored
    alike. Other columns than those of documents go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = quality.train(docs, labels.where(remainder(F.col("doc_id")) != 0))
    return quality.kept(docs.select(COLUMNS), machine)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines of 50 words or more that stand earlier are deleted from the
    texts, and n_chars is set anew. All documents stay, if with empty text; null
    texts stay null; repeated rows are one document and stay equal."""
    out = linededup.dedup(docs.select(COLUMNS))
    return out.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (five-word shingles, Jaccard 0.8 or
    more) one row stays: that of the smallest id, a null id being the greatest,
    and of several texts of this id the one of least hash. Null texts count as
    empty, and empty texts are copies of each other."""
    found = nearsets.near_duplicates(docs)
    stays = found.groupBy("root").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("_id"), F.col("text_hash").alias("_hash"))).alias("_row")).select("_row.*")
    return _rows(docs).join(stays, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says, rounded by a hash of it:
    rate 1.4 gives one row or two. Documents of unwanted domains fall towards 0.
    Repeated rows are mixed each; an empty table gives an empty one."""
    labels = label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed = mixing.mix(docs, labels, TARGETS).where("copies > 0")
    rates = mixed.select(F.coalesce("doc_id", F.lit(LAST)).alias("_id"), F.col("text_hash").alias("_hash"), "copies").dropDuplicates(["_id", "_hash"])
    return _rows(docs).join(rates, ["_id", "_hash"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each document (doc_id, n_tokens, ids, restored); null
    texts count as empty."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL can express none of the classifiers, fits and encoders.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = written(docs)
    return docs
