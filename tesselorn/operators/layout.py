"""Where files lie and belong: re-layout, unsealing, status and baselines."""

from __future__ import annotations

import json
import os
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselorn.functions import paths
from tesselorn.operators import ingest


def winners(copies: DataFrame, keys: list[str], last: bool = False) -> DataFrame:
    """Of each key's copies (sealed, path) the one that counts: loose ones before
    sealed ones; the first path, or of loose ones the last. One row a key is
    shuffled from each task, however many copies there are."""
    row = F.struct("sealed", "path")
    first = F.min(row)
    if last:  # the greatest path of loose ones; of sealed ones the first, as they are read
        best = F.coalesce(F.max(F.when(~F.col("sealed"), row)), first)
    else:
        best = first
    return copies.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


def moves(files: DataFrame) -> DataFrame:
    """(path, target, action, gen, sheep_id) of canonical files in any layout.
    A file that lies at its target stays (keep) and wins; others go there (move),
    of several the first path; the rest are superseded. Other names are no rows."""
    gen, sid = paths.parsed_name(F.element_at(F.split("path", "/"), -1))
    own = files.select("path", gen.alias("gen"), sid.alias("sheep_id")).where("gen is not null")
    root = F.element_at(F.split("path", "/"), 1)
    placed = own.withColumn("target", F.concat_ws("/", root, paths.bucket(F.col("sheep_id")), paths.file_name(F.col("gen"), F.col("sheep_id"))))
    first = placed.groupBy("target").agg(F.min(F.struct((F.col("path") != F.col("target")).alias("off"), "path"))["path"].alias("_first"))
    action = F.when(F.col("path") == F.col("target"), "keep").when(F.col("path") == F.col("_first"), "move").otherwise("superseded")
    return placed.join(first, "target").select("path", "target", action.alias("action"), "gen", "sheep_id")


def move_counts(moved: DataFrame) -> DataFrame:
    """Per generation: files moved, already in place, superseded, and buckets."""
    is_ = lambda a: F.count_if(F.col("action") == a)
    return moved.groupBy("gen").agg(is_("move").alias("moved"), is_("keep").alias("already_chunked"), is_("superseded").alias("superseded"), F.countDistinct(paths.bucket(F.col("sheep_id"))).alias("bucket_count"))


def unsealed(sealed: DataFrame, loose: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of a sealed archive to append to a corpus: those whose manifest row
    agrees and that the corpus lacks. A fault anywhere is an error, before any
    row is written; a second run finds nothing left to append."""
    keyed = sealed.withColumn("id", F.col("sheep_id"))
    faults = ingest.mismatches(keyed, manifest)
    if found := faults.limit(5).collect():
        raise ValueError(f"the archive and its manifest disagree: {[tuple(r) for r in found]}")
    return sealed.join(loose.select("gen", "sheep_id"), ["gen", "sheep_id"], "left_anti").withColumn("sealed", F.lit(False))


def status(present: DataFrame, missing: DataFrame) -> DataFrame:
    """(gen, loose_count, missing_count)."""
    return counts(present, missing).drop("bucket_count")


def counts(present: DataFrame, missing: DataFrame) -> DataFrame:
    """(gen, loose_count, missing_count, bucket_count): a baseline's counts."""
    own = present.groupBy("gen").agg(F.count("*").alias("loose_count"), F.countDistinct(F.floor(F.col("sheep_id") / paths.BUCKET)).alias("bucket_count"))
    gone = missing.distinct().groupBy("gen").agg(F.count("*").alias("missing_count"))
    return own.join(gone, "gen", "full_outer").select("gen", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("loose_count", "missing_count", "bucket_count")])


# The file of a chunked corpus's baseline, and its schema.
BASELINE, BASELINE_SCHEMA = "_chunked-verified.json", "v0.4"


def baseline_json(counted: DataFrame) -> str:
    """A baseline's text: a row for each generation, ascending; keys by name."""
    gens = [r.asDict() for r in counted.orderBy("gen").toLocalIterator()]
    return json.dumps({"schema": BASELINE_SCHEMA, "gens": gens}, indent=2, sort_keys=True) + "\n"


def baseline(spark: SparkSession, root: str) -> DataFrame | None:
    """A corpus's recorded counts; None where none were recorded, which is no drift."""
    path = Path(root) / BASELINE
    if not path.exists():
        return None
    # Spark's readers pass over names that begin with an underscore
    names = ["gen", "loose_count", "missing_count", "bucket_count"]
    rows = [tuple(int(g[n]) for n in names) for g in json.loads(path.read_text())["gens"]]
    return spark.createDataFrame(rows, "gen int, loose_count long, missing_count long, bucket_count long")


def migrate(spark: SparkSession, root: str) -> DataFrame:
    """Moves documents to their buckets, as ``moves`` has it: a copy at its target
    wins, superseded ones go, as do folders that nothing but a desktop's marks
    remain in. Gives ``move_counts``; a second run moves nothing."""
    at = Path(root)
    if not at.is_dir():
        raise FileNotFoundError(f"no corpus: {root}")
    files = [(str(f.relative_to(at)),) for f in sorted(at.rglob("*.flam3")) if f.relative_to(at).parts[0].isdigit()]
    moved = moves(spark.createDataFrame(files, "path string")).persist()
    for r in moved.where("action <> 'keep'").orderBy("action", "path").toLocalIterator():  # move comes before superseded
        old = at / r["path"]
        if r["action"] == "move":
            (at / r["target"]).parent.mkdir(parents=True, exist_ok=True)
            os.replace(old, at / r["target"])
        else:
            old.unlink()
    for folder in {(at / r["path"]).parent for r in moved.where("action <> 'keep'").select("path").collect()}:
        if removable(folder):
            shutil.rmtree(folder)
    out = spark.createDataFrame(move_counts(moved).collect(), "gen int, moved long, already_chunked long, superseded long, bucket_count long")
    moved.unpersist()
    return out


def removable(folder: Path) -> bool:
    """Whether a bucket is empty but for a desktop's marks, and is no generation."""
    return not folder.name.isdigit() and all(p.name == ".DS_Store" for p in folder.iterdir())
