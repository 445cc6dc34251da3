"""Delivery windows: packed bodies, id lists and their inverses."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselorn.functions import paths
from tesselorn.functions.fixed import BODY_VERSION, GENS_SCHEMA, WINDOW

QUALITY = 11
# How a frame and its name are found in a text.
FRAME = r"(?s)<flame\b.*?</flame>"
FRAME_NAME = r'<flame\b[^>]*\bname="([^"]*)"'


def brotli(data: bytes) -> bytes:
    return pa.Codec("brotli", compression_level=QUALITY).compress(data, asbytes=True)


def unbrotli(data: bytes) -> bytes:
    with pa.CompressedInputStream(pa.py_buffer(data), "brotli") as f:
        return f.read()


def varints(numbers: list[int]) -> bytes:
    """Unsigned LEB128. Negative numbers are an error."""
    out = bytearray()
    for n in numbers:
        if n < 0:
            raise ValueError("varints are unsigned")
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)
    return bytes(out)


def from_varints(data: bytes) -> list[int]:
    out, n, shift = [], 0, 0
    for b in data:
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            out.append(n)
            n = shift = 0
    if shift:
        raise ValueError("a number is cut off")
    return out


def pack_ids(ids: list[int]) -> bytes:
    """Sorted distinct ids as brotli of varints of their differences."""
    own = sorted(set(ids))
    return brotli(varints([b - a for a, b in zip([0, *own], own)]))


def pack_ascending(ids) -> bytes:
    """The same of ids that come ascending and distinct, one at a time: about a
    byte an id is held."""
    out, before = bytearray(), 0
    for i in ids:
        out += varints([i - before])
        before = i
    return brotli(bytes(out))


def unpack_ids(data: bytes) -> list[int]:
    out, n = [], 0
    for d in from_varints(unbrotli(data)):
        n += d
        out.append(n)
    return out


def body(documents: dict[int, str]) -> bytes:
    """A window's documents: version first, then ids ascending."""
    own = {"_v": BODY_VERSION} | {str(i): documents[i] for i in sorted(documents)}
    return brotli(json.dumps(own, ensure_ascii=False, separators=(",", ":")).encode())


def from_body(data: bytes) -> dict[int, str]:
    own = json.loads(unbrotli(data))
    return {int(k): v for k, v in own.items() if k != "_v"}


def readable(raw: DataFrame) -> DataFrame:
    """Documents that are valid UTF-8, with their text; line ends become LF."""
    ok = raw.where(F.expr("is_valid_utf8(cast(content as string))"))
    text = F.col("content").cast("string")
    return ok.withColumn("xml", F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text))


#: Ids of a stretch whose deltas one task computes.
STRETCH = 1_000_000


def deltas(ids: DataFrame) -> DataFrame:
    """(gen, sheep_id, delta) of distinct ids: difference from the one before.
    A generation is cut in stretches of numbers, so no task has it whole; the
    last id of the stretch before, a row each, is joined."""
    from pyspark.sql import Window

    own = ids.select("gen", "sheep_id").distinct().withColumn("_part", F.floor(F.col("sheep_id") / STRETCH))
    ends = own.groupBy("gen", "_part").agg(F.max("sheep_id").alias("_last"))
    ends = ends.select("gen", "_part", F.lag("_last", 1, 0).over(Window.partitionBy("gen").orderBy("_part")).alias("_before"))
    before = F.lag("sheep_id").over(Window.partitionBy("gen", "_part").orderBy("sheep_id"))
    cut = own.withColumn("_lag", before).join(ends, ["gen", "_part"])
    return cut.select("gen", "sheep_id", (F.col("sheep_id") - F.coalesce("_lag", "_before")).alias("delta"))


#: Tasks for each core among which windows are dealt, and about the bytes of
#: texts that are sent on at once.
SHARES, TEXT_BYTES = 8, 4_000_000


def windows(texts: DataFrame) -> DataFrame:
    """(gen, lo, body): one packed body for each window of at most 256 ids.
    A body's work does not follow its size (repeated frames are many bytes and
    little work), so tasks are many and of fixed number, not merged by size: cores
    wait less for the last ones."""
    schema = "gen int, lo long, body binary"
    spark = texts.sparkSession
    tasks = max(SHARES * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def fold(rows: pa.Table) -> pa.Table:
        gen, lo = rows["gen"][0].as_py(), rows["lo"][0].as_py()
        own = dict(zip(rows["sheep_id"].to_pylist(), rows["xml"].to_pylist()))
        return pa.table([pa.array([gen], pa.int32()), pa.array([lo], pa.int64()), pa.array([body(own)], pa.binary())], names=["gen", "lo", "body"])

    keyed = texts.select("gen", paths.window_start(F.col("sheep_id")).alias("lo"), "sheep_id", "xml")
    return keyed.repartition(tasks, "gen", "lo").groupBy("gen", "lo").applyInArrow(fold, schema)


def text_batches(bodies):
    """Record batches (gen, sheep_id, xml) of (gen, body), of about TEXT_BYTES
    bytes: a batch of small bodies may hold more text than one array can."""

    def batch(rows):
        gen, sid, xml = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(gen, pa.int32()), pa.array(sid, pa.int64()), pa.array(xml, pa.string())], names=["gen", "sheep_id", "xml"])

    rows, held = [], 0
    for g, data in bodies:
        for i, x in from_body(data).items():
            rows.append((g, i, x))
            held += len(x)
            if held >= TEXT_BYTES:
                yield batch(rows)
                rows, held = [], 0
    if rows:
        yield batch(rows)


def unpacked(bodies: DataFrame) -> DataFrame:
    """(gen, sheep_id, xml) of packed bodies."""

    def fold(batches):
        for b in batches:
            yield from text_batches(zip(b.column("gen").to_pylist(), b.column("body").to_pylist()))

    return bodies.mapInArrow(fold, "gen int, sheep_id long, xml string")


def id_lists(ids: DataFrame) -> DataFrame:
    """(gen, lo, hi, ids): packed id lists, a part for each million ids, so that
    no task holds a whole large generation."""
    keyed = ids.select("gen", F.floor(F.col("sheep_id") / 1_000_000).cast("long").alias("part"), "sheep_id")

    def fold(rows: pa.Table) -> pa.Table:
        own = rows["sheep_id"].to_pylist()
        return pa.table([rows["gen"][:1], pa.array([min(own)], pa.int64()), pa.array([max(own)], pa.int64()), pa.array([pack_ids(own)], pa.binary())], names=["gen", "lo", "hi", "ids"])

    return keyed.groupBy("gen", "part").applyInArrow(fold, "gen int, lo long, hi long, ids binary")


def listed(lists: DataFrame) -> DataFrame:
    """(gen, sheep_id) of packed id lists."""

    def fold(batches):
        for b in batches:
            rows = [(g, i) for g, data in zip(b.column("gen").to_pylist(), b.column("ids").to_pylist()) for i in unpack_ids(data)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())], names=["gen", "sheep_id"])

    return lists.select("gen", "ids").mapInArrow(fold, "gen int, sheep_id long")


def gens_json(generations: list[dict], build_date: str, kind: str = "all") -> str:
    own = [{k: g[k] for k in ("gen", "count", "min_id", "max_id")} for g in sorted(generations, key=lambda g: g["gen"])]
    return json.dumps({"schema": GENS_SCHEMA, "build_date": build_date, "chunk_size": WINDOW, "kind": kind, "gens": own}, ensure_ascii=False)


# Names of the delivery archive's members.
SUMMARY_NAME, LIST_NAME, WINDOW_NAME = "gens.json", "%d/avail.flam3idx", "%d/%05d.flam3chunk"


def member_names(ids: DataFrame) -> DataFrame:
    """(name) of all members of the archive of some documents."""
    own = ids.select("gen", paths.window_start(F.col("sheep_id")).alias("lo")).distinct()
    lists = own.select(F.format_string(LIST_NAME, "gen").alias("name")).distinct()
    summary = ids.sparkSession.createDataFrame([(SUMMARY_NAME,)], "name string")
    return own.select(F.format_string(WINDOW_NAME, "gen", "lo").alias("name")).union(lists).union(summary)


def classification(spark, path: str) -> DataFrame:
    """(gen, sheep_id, kind) of an index file's genomes and animations."""
    index = spark.read.json(path, multiLine=True, schema="genomes array<struct<gen: int, sheep_id: long, kind: string>>")
    return index.select(F.inline("genomes")).where("kind in ('genome', 'animation')")


def served(raw: DataFrame, records: DataFrame) -> DataFrame:
    """Genomes, and the keyframes of animations whose own file is missing: of a
    name's frames the last in a file, of files the one of least id; a genome's
    own file always wins. (gen, sheep_id, xml)."""
    text = readable(raw)
    kinds = records.select("gen", "sheep_id", "kind")
    own = text.join(kinds.where("kind = 'genome'"), ["gen", "sheep_id"], "left_semi").select("gen", "sheep_id", "xml")
    moving = text.join(kinds.where("kind = 'animation'"), ["gen", "sheep_id"], "left_semi")
    frames = moving.select("gen", F.col("sheep_id").alias("source"), F.posexplode(F.regexp_extract_all("xml", F.lit(FRAME), F.lit(0))).alias("nth", "frame"))
    named = frames.withColumn("sheep_id", paths.keyframe_id(F.regexp_extract("frame", FRAME_NAME, 1))).where("sheep_id is not null")
    orphans = named.join(own, ["gen", "sheep_id"], "left_anti").groupBy("gen", "sheep_id").agg(F.min_by("frame", F.struct("source", -F.col("nth"))).alias("xml"))
    return own.unionByName(orphans)
