"""Release artifacts, written on the driver from ordered streams of rows."""

from __future__ import annotations

import csv
import io
import json
import os
import shutil
import tarfile
import zipfile
from collections.abc import Iterator
from itertools import groupby
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselorn.functions import paths
from tesselorn.functions.fixed import FILE_PREFIX, MANIFEST, SCHEMA_VERSION
from tesselorn.operators import delivery, features, ingest, parse, recipes, stats
from tesselorn.operators.ingest import atomic
from tesselorn.sources.corpus import generations, scanned

STAMP = (1980, 1, 1, 0, 0, 0)
#: What the bundle and a release have besides the generations.
BESIDE = ["_index/index.json", "_index/INDEX.md", "ATTRIBUTION.md"]


def manifest_csv(path: str, rows: DataFrame) -> None:
    """Rows by id, a row at a time; CRLF line ends, True and False as Python has them."""
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, MANIFEST)
        w.writeheader()
        for r in rows.select(*MANIFEST).orderBy("id").toLocalIterator():
            w.writerow(r.asDict())


def _members(raw: DataFrame) -> Iterator[tuple[str, bytes]]:
    sid = F.col("sheep_id")
    named = raw.select("sheep_id", "content", F.concat_ws("/", paths.bucket(sid), paths.file_name(F.col("gen"), sid)).alias("member"))
    return ((r["member"], bytes(r["content"])) for r in named.orderBy("sheep_id").toLocalIterator())


def gen_zip(path: str, raw: DataFrame, manifest: DataFrame, missing: bytes) -> None:
    """A generation: manifest, missing list, then documents by id, a row at a time."""
    manifest_csv(f"{path}.csv", manifest)
    with zipfile.ZipFile(f"{path}.tmp", "w", zipfile.ZIP_DEFLATED, compresslevel=9) as z:
        with open(f"{path}.csv", "rb") as f, z.open(zipfile.ZipInfo("MANIFEST.csv", STAMP), "w", force_zip64=True) as to:
            shutil.copyfileobj(f, to)
        z.writestr(zipfile.ZipInfo("missing.txt", STAMP), missing, zipfile.ZIP_DEFLATED, 9)
        for name, data in _members(raw):
            z.writestr(zipfile.ZipInfo(name, STAMP), data, zipfile.ZIP_DEFLATED, 9)
    os.remove(f"{path}.csv")
    os.replace(f"{path}.tmp", path)


def _add(t: tarfile.TarFile, name: str, data: bytes) -> None:
    info = tarfile.TarInfo(name)
    info.size, info.mtime, info.mode = len(data), 0, 0o644
    t.addfile(info, io.BytesIO(data))


def mega(path: str, zips: dict[int, str], root: str) -> None:
    """All generations, each under its number as its own zip has it, of which the
    members come; then the index and the attribution of the corpus."""
    with tarfile.open(f"{path}.tmp", "w:xz", preset=6) as t:
        for gen in sorted(zips):
            with zipfile.ZipFile(zips[gen]) as z:
                for name in z.namelist():
                    _add(t, f"{gen}/{name}", z.read(name))
        for name in BESIDE:
            if (Path(root) / name).exists():
                _add(t, name, (Path(root) / name).read_bytes())
    os.replace(f"{path}.tmp", path)


def chunk_members(texts: DataFrame, build_date: str, kind: str) -> Iterator[tuple[str, bytes]]:
    """(name, data) of all members of the delivery archive, by name: the summary
    of generations, and of each its id list and its windows."""
    gens = {r["gen"]: r.asDict() for r in stats.generations(texts).collect()}
    ids = texts.select("gen", "sheep_id").distinct().orderBy("gen", "sheep_id").toLocalIterator()
    lists = {g: delivery.pack_ascending(r["sheep_id"] for r in rows) for g, rows in groupby(ids, lambda r: r["gen"])}
    head = {delivery.SUMMARY_NAME: delivery.gens_json(list(gens.values()), build_date, kind).encode()}
    pending = sorted((head | {delivery.LIST_NAME % g: data for g, data in lists.items()}).items())
    named = delivery.windows(texts).select(F.format_string(delivery.WINDOW_NAME, "gen", "lo").alias("name"), "body")
    for r in named.orderBy("name").toLocalIterator():
        while pending and pending[0][0] < r["name"]:
            yield pending.pop(0)
        yield r["name"], bytes(r["body"])
    yield from pending


def chunks(path: str, raw: DataFrame, build_date: str, kinds: DataFrame | None = None) -> None:
    """The delivery archive of loose documents (layout = delivery). With ``kinds``
    (gen, sheep_id, kind), genomes and orphan keyframes only."""
    texts = delivery.readable(raw).select("gen", "sheep_id", "xml") if kinds is None else delivery.served(raw, kinds)
    texts = texts.persist()
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(f"{path}.tmp", "w") as t:
        for name, data in chunk_members(texts, build_date, "all" if kinds is None else "genome"):
            _add(t, name, data)
    os.replace(f"{path}.tmp", path)
    texts.unpersist()


def _plain(row) -> dict:
    """A record's fields by its kind."""
    d = {k: v for k, v in row.asDict(recursive=True).items() if k != "scan_seq"}
    base = ["id", "gen", "sheep_id", "byte_size", "kind", "valid"]
    if d["kind"] == "corrupt":
        return {k: d[k] for k in [*base, "error", "sealed"]}
    if d["kind"] == "animation":
        return {k: d[k] for k in [*base, "frame_count", "sealed"]}
    return {k: v for k, v in d.items() if k != "error"}


def index_json(path: str, records: DataFrame, build_date: str) -> None:
    """The index, a record at a time: compact, ASCII, one line."""
    with open(f"{path}.tmp", "w", encoding="ascii", newline="") as f:
        f.write(f'{{"_schema_version":{SCHEMA_VERSION},"_build_date":{json.dumps(build_date)},"genomes":[')
        for n, r in enumerate(records.orderBy("scan_seq").toLocalIterator()):
            f.write("," * bool(n) + json.dumps(_plain(r), separators=(",", ":")))
        f.write("]}\n")
    os.replace(f"{path}.tmp", path)


INTRO = """All documents of the corpus by generation and kind, and what their contents have
in common. Counts are of genomes unless a table says otherwise.

- genome: a single flame
- animation: several flames, the frames of a loop
- corrupt: neither; its error says why

Names are `{prefix}.<generation>.<id>.flam3`, in folders of {bucket:,} ids."""


def index_md(records: DataFrame, build_date: str) -> str:
    """The report on an index: tables of all its aggregates, and its look-ups."""
    show = lambda v: "" if v is None else f"{v:,}" if isinstance(v, int) else f"{v:.2f}" if isinstance(v, float) else str(v)
    table = lambda names, rows: ["| " + " | ".join(names) + " |", "|" + " --- |" * len(names), *["| " + " | ".join(show(v) for v in r) + " |" for r in rows]]

    def lines(title: str, df: DataFrame) -> list[str]:
        return [f"\n## {title}\n", *table(df.columns, [tuple(r) for r in df.collect()])]

    def two_columns(title: str, df: DataFrame) -> list[str]:
        """A long table in two columns, read downwards."""
        rows = [tuple(r) for r in df.collect()]
        half, gap = -(-len(rows) // 2), ("",) * len(df.columns)
        return [f"\n## {title}\n", *table([*df.columns, *df.columns], [a + b for a, b in zip(rows[:half], [*rows[half:], gap])])]

    kb = lambda c: F.round(F.col(c) / 1024, 1).alias(c.replace("bytes", "kb"))
    shape = stats.corpus_shape(records).orderBy(F.asc_nulls_last("gen")).select("gen", "total", "genome", "animation", "corrupt", kb("min_bytes"), kb("max_bytes"))
    out = [f"# Index of {build_date}\n", INTRO.format(prefix=FILE_PREFIX, bucket=paths.BUCKET)]
    for title, df in [("Summary", stats.summary(records)), ("Corpus shape", shape)]:
        out += lines(title, df)
    out += two_columns("Variations", stats.variation_histogram(records).drop("first_seq"))
    parts = [("Structure", stats.structural(records)), ("Safety", stats.safety(records)), ("Tone map", stats.tone_map(records)), ("Versions", stats.versions(records).drop("first_seq")), ("Malformations", stats.malformations(records).orderBy(F.asc_nulls_last("gen"))), ("Xforms", stats.xform_histogram(records)), ("Variations a xform", stats.density(records)), ("Dense genomes", stats.dense_genomes(records))]
    if records.where("kind = 'animation'").limit(1).count():
        parts.append(("Animation frames", stats.frame_bins(records)))
    if records.where("kind = 'corrupt'").limit(1).count():
        parts.append(("Corrupt documents", stats.corrupt_errors(records).drop("first_seq")))
    for title, df in parts:
        out += lines(title, df)
    found = [("with_variation(r, 'linear')", recipes.with_variation(records, "linear")), ("gpu_safe(r)", recipes.gpu_safe(records)), ("parity(r)", recipes.parity(records)), ("low_complexity(r)", recipes.low_complexity(records)), ("without_nan(r)", recipes.without_nan(records))]
    counted = [(f"`recipes.{name}`", df.count()) for name, df in found]
    out += ["\n## Look-ups\n", "Functions of `tesselorn.operators.recipes` over the records, and how many genomes each finds.\n", *table(["look-up", "genomes"], counted)]
    return "\n".join([*out, ""])


def index(spark: SparkSession, root: str, out: str, build_date: str) -> None:
    """Both index files of a corpus."""
    parsed = parse.parsed(scanned(spark, root))
    records = features.records(parsed).withColumn("scan_seq", paths.scan_key(F.col("gen"), F.col("sheep_id"))).persist()
    Path(out).mkdir(parents=True, exist_ok=True)
    index_json(f"{out}/index.json", records, build_date)
    atomic(f"{out}/INDEX.md", index_md(records, build_date).encode())
    records.unpersist()


def build(spark: SparkSession, root: str, out: str, build_date: str, live_base: str, archive_base: str, only_gen: int | None = None, regen_index: bool = True, skip_mega: bool = False, skip_chunks: bool = False) -> list[str]:
    """All artifacts of a corpus, and their paths; with ``only_gen`` that
    generation's zip only. Each generation is scanned and parsed by itself, once;
    the bundle takes its members from the zips, so both have the same bytes."""
    if only_gen is not None and not (Path(root) / str(only_gen)).is_dir():
        raise FileNotFoundError(f"no generation {only_gen} in {root}")
    Path(out).mkdir(parents=True, exist_ok=True)
    if only_gen is None and regen_index:
        index(spark, root, f"{root}/_index", build_date)
    zips = {}
    for g in generations(root) if only_gen is None else [only_gen]:
        raw = scanned(spark, root, layout="gather").where(F.col("gen") == g).persist()
        zips[g] = f"{out}/{paths.gen_zip_name(g, build_date)}"
        manifest = features.manifest(parse.parsed(raw), f"{build_date}T00:00:00Z", live_base, archive_base)
        gen_zip(zips[g], raw, manifest, ingest.Absences(f"{root}/{g}/missing.txt").load().text().encode())
        raw.unpersist()
    made = list(zips.values())
    if only_gen is not None:
        return made
    for name in ("_index/INDEX.md", "_index/index.json", "ATTRIBUTION.md"):
        if (Path(root) / name).exists():
            made.append(shutil.copy2(Path(root) / name, f"{out}/{Path(name).name}"))
    if not skip_mega:
        made.append(f"{out}/{paths.mega_name(build_date)}")
        mega(made[-1], zips, root)
    if not skip_chunks:
        made.append(f"{out}/{paths.chunks_name(build_date)}")
        chunks(made[-1], scanned(spark, root, layout="delivery"), build_date)
    return made
