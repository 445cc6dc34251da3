"""Ingest: what to fetch, what came of it, and imports; and drift guards."""

from __future__ import annotations

import os
import random
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselorn.functions.fixed import FILE_PREFIX, LIVE_GENS
from tesselorn.operators.parse import is_document


def parse_range(text: str) -> tuple[int, int]:
    """'A..B' with A below B."""
    a, sep, b = text.partition("..")
    if not sep or not a.isdigit() or not b.isdigit() or int(a) >= int(b):
        raise ValueError(f"not a range: {text!r}")
    return int(a), int(b)


def require_live(gen: int) -> None:
    if gen not in LIVE_GENS:
        raise ValueError(f"generation {gen} is not live")


def plan(spark: SparkSession, gen: int, start: int, end: int, present: DataFrame, missing: DataFrame) -> DataFrame:
    """(sheep_id, outcome) for each id of [start, end): local, known_missing, or
    fetch. present, missing: (gen, sheep_id)."""
    ids = spark.range(start, end).withColumnRenamed("id", "sheep_id")
    here = present.where(F.col("gen") == gen).select("sheep_id", F.lit(True).alias("_here")).distinct()
    gone = missing.where(F.col("gen") == gen).select("sheep_id", F.lit(True).alias("_gone")).distinct()
    outcome = F.when(F.col("_here"), "local").when(F.col("_gone"), "known_missing").otherwise("fetch")
    return ids.join(here, "sheep_id", "left").join(gone, "sheep_id", "left").select("sheep_id", outcome.alias("outcome"))


def fetch(planned: DataFrame, get: Callable[[int], tuple[int, bytes]], write: Callable[[int, bytes], None], forget: Callable[[int], None], delay: float = 20.0, jitter: float = 5.0, sleep=time.sleep) -> dict[str, int]:
    """Fetches the planned ids one after the other, politely: a pause of delay to
    delay + jitter after each request. A 200 with a document is written; a 404 is
    remembered by ``forget`` at once; all else is transient and tried again in a
    later run. ``get`` is the caller's client; nothing here knows a network."""
    stats = {r["outcome"]: r["count"] for r in planned.groupBy("outcome").count().collect()}
    out = {"local": stats.get("local", 0), "known_missing": stats.get("known_missing", 0), "fetched": 0, "missing": 0, "transient": 0}
    for row in planned.where("outcome = 'fetch'").orderBy("sheep_id").toLocalIterator():
        sid = row["sheep_id"]
        try:
            status, data = get(sid)
        except OSError:
            status, data = 0, b""
        if status == 200 and is_document(data):
            write(sid, data)
            out["fetched"] += 1
        elif status == 404:
            forget(sid)
            out["missing"] += 1
        else:
            out["transient"] += 1
        sleep(delay + random.uniform(0, jitter))
    return out


def gaps(spark: SparkSession, gen: int, start: int, end: int, present: DataFrame, missing: DataFrame) -> DataFrame:
    """Ids of [start, end) that are neither present nor known to be missing."""
    return plan(spark, gen, start, end, present, missing).where("outcome = 'fetch'").select("sheep_id")


def imported(source: DataFrame, corpus: DataFrame, gen: int | None = None) -> DataFrame:
    """Rows of ``source`` that the corpus lacks; never clobbers one. Several
    generations without ``gen`` are an error."""
    if gen is not None:
        source = source.where(F.col("gen") == gen)
    elif source.select("gen").distinct().limit(2).count() > 1:
        raise ValueError("several generations: name one")
    return source.join(corpus.select("gen", "sheep_id"), ["gen", "sheep_id"], "left_anti")


def missing_lists(spark: SparkSession, found: list[str]) -> DataFrame:
    """(gen, sheep_id) of missing lists: a number a line, blank lines apart; the
    generation is the folder's name. No list is an empty one."""
    if not found:
        return spark.createDataFrame([], "gen int, sheep_id long")
    lines = spark.read.text(found).select(F.trim("value").alias("v"), F.element_at(F.split(F.input_file_name(), "/"), -2).cast("int").alias("gen"))
    return lines.where("v <> ''").select("gen", F.col("v").cast("long").alias("sheep_id")).distinct()


class Absences:
    """One generation's missing list, held by whoever fetches: a file of numbers."""

    def __init__(self, path: str | Path):
        self.path, self.ids = Path(path), set()

    def load(self) -> Absences:
        self.ids = {int(x) for x in self.path.read_text().split()} if self.path.exists() else set()
        return self

    def __contains__(self, sheep_id: int) -> bool:
        return sheep_id in self.ids

    def __len__(self) -> int:
        return len(self.ids)

    def add(self, sheep_id: int) -> None:
        self.ids.add(sheep_id)

    def text(self) -> str:
        return "".join(f"{i}\n" for i in sorted(self.ids))

    def save(self) -> None:
        atomic(self.path, self.text().encode())


def atomic(path: str | Path, data: bytes) -> None:
    """Writes a file whole or not at all."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(f"{path}.tmp").write_bytes(data)
    os.replace(f"{path}.tmp", path)


ATTRIBUTION = "# Attribution\n\nThe documents in this folder are works of their designers; see the licence of their source.\n"


def initialise(root: str) -> None:
    """Makes a corpus folder with a note of attribution, unless it has one."""
    note = Path(root) / "ATTRIBUTION.md"
    if not note.exists():
        atomic(note, ATTRIBUTION.encode())


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(id, sha256, file_size_bytes, ...) of a manifest file, by its header."""
    rows = spark.read.csv(path, header=True, escape='"', multiLine=True)
    return rows.withColumns({"id": F.col("id").cast("long"), "file_size_bytes": F.col("file_size_bytes").cast("long")})


def sidecar_ids(spark: SparkSession, path: str, gen: int) -> DataFrame:
    """The same of a scraper's side file; other lines are passed over. Spark's
    readers skip names that begin with an underscore, as the side file's does."""
    lines = spark.createDataFrame([(x,) for x in Path(path).read_text().splitlines()], "value string").select(F.trim("value").alias("v")).where(F.col("v").rlike(r"^-*\d+$"))
    return lines.select(F.lit(gen).alias("gen"), F.col("v").try_cast("long").alias("sheep_id")).where("sheep_id is not null").distinct()


def drift(baseline: DataFrame, current: DataFrame, counts: list[str]) -> DataFrame:
    """(gen, what, expected, actual): counts that shrank since the baseline. A
    generation that is gone counts 0; growth and new generations are no drift."""
    now = current.select("gen", *[F.col(c).alias(f"_{c}") for c in counts])
    both = baseline.select("gen", *counts).join(now, "gen", "left")
    pairs = F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("long").alias("expected"), F.coalesce(F.col(f"_{c}"), F.lit(0)).cast("long").alias("actual")) for c in counts])
    return both.select("gen", F.inline(pairs)).where("actual < expected")


def flat_residue(files: DataFrame) -> DataFrame:
    """(gen, what, expected, actual): documents that lie flat at a generation's
    root, of paths below the corpus. Any is a fault, with or without a baseline."""
    gen = F.regexp_extract("path", rf"^([0-9]+)/{FILE_PREFIX}\.\1\..*\.flam3$", 1)
    flat = files.select(gen.alias("gen")).where("gen <> ''").groupBy(F.col("gen").cast("int").alias("gen")).agg(F.count("*").alias("actual"))
    return flat.select("gen", F.lit("flat_files").alias("what"), F.lit(0).cast("long").alias("expected"), "actual")


def total_drift(baseline: DataFrame, current: DataFrame, counts: list[str]) -> DataFrame:
    """The same over the sum of the counts of a generation."""
    add = lambda df: df.select("gen", sum((F.col(c) for c in counts), F.lit(0)).alias("total"))
    return drift(add(baseline), add(current), ["total"])


def mismatches(contents: DataFrame, manifest: DataFrame) -> DataFrame:
    """(id, problem): archive members against their manifest, both ways."""
    own = contents.select("id", F.sha2("content", 256).alias("_hash"), F.octet_length("content").alias("_size"))
    both = own.join(manifest.select("id", "sha256", "file_size_bytes"), "id", "full_outer")
    problem = F.when(F.col("_hash").isNull(), "not in the archive").when(F.col("sha256").isNull(), "not in the manifest").when(F.col("_size") != F.col("file_size_bytes"), "size").when(F.col("_hash") != F.col("sha256"), "sha256")
    return both.select("id", problem.alias("problem")).where("problem is not null")
