"""Command line: ``spark-submit`` or ``python -m tesselorn COMMAND``.

A corpus is a folder of generations: documents, archives and missing.txt lists.
"""

from __future__ import annotations

import argparse
import sys
import urllib.error
import urllib.request
from collections import Counter
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselorn.functions import paths
from tesselorn.functions.fixed import FILE_PREFIX, LIVE_GENS
from tesselorn.operators import delivery, ingest, layout, release, unseal
from tesselorn.sources.corpus import scanned

LIVE_BASE, ARCHIVE_BASE = "http://localhost", "http://localhost/archive"


def absent(spark: SparkSession, root: str) -> DataFrame:
    """All missing lists of a corpus."""
    return ingest.missing_lists(spark, [str(p) for p in sorted(Path(root).glob("*/missing.txt")) if p.parent.name.isdigit()])


def stored(root: str, gen: int, sheep_id: int) -> Path:
    """Where a document lies."""
    return Path(root) / str(gen) / f"{sheep_id // paths.BUCKET * paths.BUCKET:05d}" / f"{FILE_PREFIX}.{gen}.{sheep_id:05d}.flam3"


def bring_in(spark: SparkSession, root: str, source: str, gen: int | None) -> dict[str, int]:
    """Imports a folder's documents, which are never put over ours, and the
    absences of its side file, into one generation. Gives how many came, were
    there already, and were remembered as absent."""
    if not source or not Path(source).is_dir():
        raise FileNotFoundError(f"import source not found: {source}")
    rows = scanned(spark, source, layout="any")
    wanted = rows if gen is None else rows.where(F.col("gen") == gen)
    new = ingest.imported(rows, scanned(spark, root).drop("content"), gen)
    counts = Counter(imported=0, skipped=0, remembered=0)
    for r in new.toLocalIterator():
        ingest.atomic(stored(root, r["gen"], r["sheep_id"]), bytes(r["content"]))
        counts["imported"] += 1
    counts["skipped"] = wanted.count() - counts["imported"]
    gen = gen if gen is not None else next((r["gen"] for r in rows.select("gen").limit(1).collect()), None)
    side = Path(source) / "_missing_404.txt"
    if gen is not None and side.exists():
        kept = ingest.Absences(Path(root) / str(gen) / "missing.txt").load()
        for r in ingest.sidecar_ids(spark, str(side), gen).toLocalIterator():
            counts["remembered"] += r["sheep_id"] not in kept
            kept.add(r["sheep_id"])
        kept.save()
    return dict(counts)


def client(base: str, gen: int, timeout: float = 30.0):
    """A function from an id to the live server's status and answer."""

    def get(sheep_id: int) -> tuple[int, bytes]:
        name = f"{FILE_PREFIX}.{gen}.{sheep_id:05d}.flam3"
        try:
            with urllib.request.urlopen(f"{base}/gen/{gen}/{sheep_id}/{name}", timeout=timeout) as answer:
                return answer.status, answer.read()
        except urllib.error.HTTPError as e:
            return e.code, b""

    return get


def fetched(spark: SparkSession, root: str, gen: int, span: tuple[int, int], base: str, **pauses) -> dict[str, int]:
    """Fetches the gaps of a live generation, one id after the other."""
    ingest.require_live(gen)
    ingest.initialise(root)
    kept = ingest.Absences(Path(root) / str(gen) / "missing.txt").load()

    def forget(sheep_id: int) -> None:
        kept.add(sheep_id)
        kept.save()

    planned = ingest.plan(spark, gen, *span, scanned(spark, root, gen=str(gen)), absent(spark, root))
    return ingest.fetch(planned, client(base, gen), lambda i, data: ingest.atomic(stored(root, gen, i), data), forget, **pauses)


def chunked_faults(spark: SparkSession, root: str) -> list:
    """Flat files at a generation's root, always; and what fell below the baseline."""
    at = Path(root)
    flat = [(str(f.relative_to(at)),) for f in sorted(at.glob(f"*/{FILE_PREFIX}.*.flam3"))]
    faults = ingest.flat_residue(spark.createDataFrame(flat, "path string")).orderBy("gen").collect()
    if (recorded := layout.baseline(spark, root)) is not None:
        faults += ingest.drift(recorded, layout.counts(scanned(spark, root), absent(spark, root)), ["loose_count", "missing_count", "bucket_count"]).collect()
    return faults


def unsealed_faults(spark: SparkSession, root: str) -> list:
    return unseal.consistency(spark, root, scanned(spark, root), absent(spark, root)).collect()


def told(faults: list) -> int:
    for r in faults:
        print(f"generation {r['gen']}: {r['what']} was {r['expected']}, is {r['actual']}")
    return 1 if faults else 0


COMMANDS = ["fetch", "fetch-all", "import", "index", "release-build", "unseal", "verify-unseal", "migrate", "baseline", "verify", "chunk", "status", "gaps"]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tesselorn")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("corpus")
    p.add_argument("--out")
    p.add_argument("--gen", type=int)
    p.add_argument("--range", dest="span", default="0..50000")
    p.add_argument("--date", default=datetime.now(timezone.utc).date().isoformat())
    p.add_argument("--source")
    p.add_argument("--snapshots")
    p.add_argument("--index", help="the index file of a genome-only chunk")
    p.add_argument("--genome-only", action="store_true")
    p.add_argument("--keep-index", action="store_true")
    p.add_argument("--skip-mega", action="store_true")
    p.add_argument("--skip-chunks", action="store_true")
    p.add_argument("--delay", type=float, default=20.0)
    p.add_argument("--jitter", type=float, default=5.0)
    p.add_argument("--live-base", default=LIVE_BASE)
    p.add_argument("--archive-base", default=ARCHIVE_BASE)
    a = p.parse_args(argv)
    datetime.strptime(a.date, "%Y-%m-%d")  # other dates are an error
    spark = SparkSession.builder.getOrCreate()
    root, pauses = a.corpus, {"delay": a.delay, "jitter": a.jitter}
    out = Path(a.out or ".")
    if a.command == "index":
        release.index(spark, root, a.out or f"{root}/_index", a.date)
    elif a.command == "release-build":
        for path in release.build(spark, root, str(out), a.date, a.live_base, a.archive_base, a.gen, not a.keep_index, a.skip_mega, a.skip_chunks):
            print(path)
    elif a.command == "chunk":
        kinds = None
        if a.genome_only:
            index = Path(a.index or f"{root}/_index/index.json")
            if not index.exists():
                raise FileNotFoundError(f"no index: {index}")
            kinds = delivery.classification(spark, str(index))
        release.chunks(f"{out}/{paths.chunks_name(a.date)}", scanned(spark, root, layout="delivery"), a.date, kinds)
    elif a.command == "status":
        layout.status(scanned(spark, root), absent(spark, root)).orderBy("gen").show(1000, False)
    elif a.command == "gaps":
        ingest.require_live(a.gen)
        for r in ingest.gaps(spark, a.gen, *ingest.parse_range(a.span), scanned(spark, root, gen=str(a.gen)), absent(spark, root)).orderBy("sheep_id").toLocalIterator():
            print(r["sheep_id"])
    elif a.command == "fetch":
        print(fetched(spark, root, a.gen, ingest.parse_range(a.span), a.live_base, **pauses))
    elif a.command == "fetch-all":
        # a corpus that lost ids would be fetched again: both guards come first
        ingest.initialise(root)
        if told(chunked_faults(spark, root) + unsealed_faults(spark, root)):
            return 1
        for gen in LIVE_GENS:
            print(gen, fetched(spark, root, gen, ingest.parse_range(a.span), a.live_base, **pauses))
    elif a.command == "import":
        ingest.initialise(root)
        print(bring_in(spark, root, a.source, a.gen))
    elif a.command == "unseal":
        gens = {"snapshots": a.snapshots}
        for row in [unseal.Unsealing(spark, root, a.gen, **gens).run()] if a.gen is not None else unseal.unseal_all(spark, root, **gens):
            print(row)
    elif a.command == "verify-unseal":
        return told(unsealed_faults(spark, root))
    elif a.command == "baseline":
        ingest.atomic(Path(root) / layout.BASELINE, layout.baseline_json(layout.counts(scanned(spark, root), absent(spark, root))).encode())
    elif a.command == "verify":
        return told(chunked_faults(spark, root))
    elif a.command == "migrate":
        for r in layout.migrate(spark, root).orderBy("gen").collect():
            print(r.asDict())
        ingest.atomic(Path(root) / layout.BASELINE, layout.baseline_json(layout.counts(scanned(spark, root), absent(spark, root))).encode())
    return 0


if __name__ == "__main__":
    sys.exit(main())
