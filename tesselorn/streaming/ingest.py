"""An extension: index records of documents as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselorn.functions import paths
from tesselorn.operators import features, parse

#: Columns of Spark's source of whole files.
FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_records(spark: SparkSession, root: str) -> DataFrame:
    """Records of the canonical files under a root. Spark's file stream passes
    over zero-byte files and hidden folders; the batch source does not."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").load(root)
    gen, sid = paths.parsed_name(F.element_at(F.split("path", "/"), -1))
    raw = files.select(gen.alias("gen"), sid.alias("sheep_id"), "content", F.lit(False).alias("sealed")).where("gen is not null")
    return features.records(parse.parsed(raw))


def run_once(spark: SparkSession, root: str, out: str, checkpoint: str) -> None:
    """Appends the records of files not seen before to a Parquet table."""
    stream_records(spark, root).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
