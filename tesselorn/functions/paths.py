"""Names, paths and buckets as column expressions. Numbers are padded to five
digits at least, never cut."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tesselorn.functions.fixed import BUCKET, FILE_PREFIX, LIVE_GENS, WINDOW


def file_name(gen: Column, sid: Column) -> Column:
    return F.format_string(f"{FILE_PREFIX}.%d.%05d.flam3", gen, sid)


def bucket_start(sid: Column) -> Column:
    return (F.floor(sid / BUCKET) * BUCKET).cast("long")


def bucket(sid: Column) -> Column:
    return F.format_string("%05d", bucket_start(sid))


def file_path(gen: Column, sid: Column, root: str) -> Column:
    return F.concat_ws("/", F.lit(root), gen.cast("string"), bucket(sid), file_name(gen, sid))


def scan_key(gen: Column, sid: Column) -> Column:
    """Orders documents as a scan meets them: by path, as text."""
    return F.concat_ws("/", gen.cast("string"), bucket(sid), file_name(gen, sid))


def window_start(sid: Column) -> Column:
    return (F.floor(sid / WINDOW) * WINDOW).cast("long")


def window_name(gen: Column, sid: Column) -> Column:
    return F.format_string("%d/%05d.flam3chunk", gen, window_start(sid))


def record_id(gen: Column, sid: Column) -> Column:
    return F.format_string("%d/%05d", gen, sid)


def remote_url(gen: Column, sid: Column, base: str) -> Column:
    return F.concat(F.format_string(f"{base}/gen/%d/%d/", gen, sid), file_name(gen, sid))


def archive_url(gen: Column, sid: Column, base: str) -> Column:
    return F.format_string(f"{base}/generation-%d/%d/spex", gen, sid)


def source_url(gen: Column, sid: Column, live_base: str, archive_base: str) -> Column:
    """Live generations from the live server, others from the archive."""
    return F.when(gen.isin(LIVE_GENS), remote_url(gen, sid, live_base)).otherwise(archive_url(gen, sid, archive_base))


NAME_PATTERN = rf"^{FILE_PREFIX}\.(\d+)\.(\d{{5,}})\.flam3$"


def parsed_name(name: Column) -> tuple[Column, Column]:
    """(gen, id) of a canonical file name; nulls for others."""
    ok = name.rlike(NAME_PATTERN)
    part = lambda i: F.when(ok, F.regexp_extract(name, NAME_PATTERN, i))
    return part(1).cast("int"), part(2).cast("long")


def gen_zip_name(gen: int, date: str) -> str:
    return f"gen-{gen}-{date}.zip"


def undated_zip_path(gen: int, folder: str) -> str:
    return f"{folder}/gen-{gen}.zip"


def mega_name(date: str) -> str:
    return f"corpus-all-{date}.tar.xz"


def chunks_name(date: str) -> str:
    return f"corpus-chunks-{date}.tar"


def keyframe_id(name: Column) -> Column:
    """The number that ends a record's name; null where there is none."""
    found = F.regexp_extract(F.coalesce(name, F.lit("")), r"\.(\d+)$", 1)
    return F.when(found != "", found).try_cast("long")
