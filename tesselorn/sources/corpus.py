"""A Python data source over a corpus: loose files and sealed archives.

    spark.dataSource.register(CorpusSource)
    spark.read.format("flamecorpus").load(root)

Rows: gen, sheep_id, content, sealed, path. Loose files win over sealed members
of the same id, the first path over later ones; contents are read only for the
winners. Zero-byte files are rows. Hidden folders are searched too. The root is
a folder that driver and executors see under one path. A filter gen = N, or the
option gen, lists and reads that generation alone. Option layout:

- any: canonical names anywhere under the root, whatever their folders; archives
  are not opened.
- gather: what a release packs: of several loose copies the last path wins, and a
  generation with archives and loose files at once is warned of.
- delivery: loose files exactly two folders deep, ids of any width, the
  generation by the file's name; the last path wins.
"""

from __future__ import annotations

import logging
import os
import re
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from tesselorn.functions.fixed import FILE_PREFIX

SCHEMA = "gen int, sheep_id long, content binary, sealed boolean, path string"
_NAME = re.compile(rf"^{FILE_PREFIX}\.(\d+)\.(\d{{5,}})\.flam3$")
_ZIP = re.compile(r"^.{5}-.{5}\.zip$")
FILES = 2000


class Files(InputPartition):
    def __init__(self, rows):
        self.rows = rows


def generations(root: str) -> list[int]:
    """Numbers of the folders that are named by one."""
    return sorted(int(p.name) for p in Path(root).iterdir() if p.is_dir() and re.fullmatch(r"[0-9]+", p.name))


def listing(root: str, gen: int | None = None, last: bool = False) -> list[tuple[int, int, bool, str, str]]:
    """(gen, id, sealed, path, member) of all documents; the first path wins, or
    of loose ones the last."""
    found: dict[tuple[int, int], tuple] = {}
    for number in generations(root):
        d = Path(root) / str(number)
        if (gen is not None and number != gen) or not d.is_dir():
            continue
        for top, _, names in sorted(os.walk(d)):
            for name in sorted(names):
                if (m := _NAME.match(name)) and m[1] == d.name and (last or (number, int(m[2])) not in found):
                    found[number, int(m[2])] = (False, f"{top}/{name}", "")
        archives = sorted(p for p in d.iterdir() if _ZIP.match(p.name))
        if last and archives and any(k[0] == number for k in found):
            logging.getLogger(__name__).warning("generation %d has %d archives and loose files: an unsealing that did not end?", number, len(archives))
        for z in archives:
            with zipfile.ZipFile(z) as archive:
                for name in archive.namelist():
                    if (m := _NAME.match(name)) and m[1] == d.name:
                        found.setdefault((number, int(m[2])), (True, str(z), name))
    return [(*k, *v) for k, v in found.items()]


def deliverable(root: str) -> list[tuple[int, int, bool, str, str]]:
    """The same of files two folders deep, by looser names."""
    found: dict[tuple[int, int], tuple] = {}
    for path in sorted(str(p) for p in Path(root).glob(f"*/*/{FILE_PREFIX}.*.flam3")):
        if m := re.fullmatch(rf"{FILE_PREFIX}\.(\d+)\.(\d+)\.flam3", os.path.basename(path)):
            found[int(m[1]), int(m[2])] = (False, path, "")
    return [(*k, *v) for k, v in found.items()]


def loose(root: str) -> list[tuple[int, int, bool, str, str]]:
    """The same of canonical files anywhere under a root, by their names alone:
    an import's source. First path wins."""
    found: dict[tuple[int, int], tuple] = {}
    for path in sorted(str(p) for p in Path(root).rglob(f"{FILE_PREFIX}.*.flam3")):
        if m := _NAME.match(os.path.basename(path)):
            found.setdefault((int(m[1]), int(m[2])), (False, path, ""))
    return [(*k, *v) for k, v in found.items()]


class CorpusReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.layout = options["path"], options.get("layout")
        self.gen = int(options["gen"]) if options.get("gen") else None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("gen",) and self.gen in (None, f.value):
                self.gen = f.value
            else:
                yield f

    def partitions(self):
        whole = {"any": loose, "delivery": deliverable}.get(self.layout)
        rows = [r for r in whole(self.root) if self.gen in (None, r[0])] if whole else listing(self.root, self.gen, self.layout == "gather")
        rows.sort(key=lambda r: (r[3], r[4]))
        return [Files(rows[i : i + FILES]) for i in range(0, len(rows), FILES)] or [Files([])]

    def read(self, partition):
        archive, name = None, None
        for at in range(0, max(len(partition.rows), 1), 200):
            rows = partition.rows[at : at + 200]
            contents = []
            for *_, sealed, path, member in rows:
                if sealed:
                    if path != name:
                        archive, name = zipfile.ZipFile(path), path
                    contents.append(archive.read(member))
                else:
                    contents.append(Path(path).read_bytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array(contents, pa.binary()), pa.array([r[2] for r in rows], pa.bool_()), pa.array([r[3] for r in rows], pa.string())],
                names=["gen", "sheep_id", "content", "sealed", "path"],
            )


class CorpusSource(DataSource):
    @classmethod
    def name(cls):
        return "flamecorpus"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return CorpusReader(self.options)


def scanned(spark: SparkSession, root: str, **options) -> DataFrame:
    """The rows of a corpus; filters on gen reach the listing."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CorpusSource)
    return spark.read.format("flamecorpus").options(**options).load(root)
