"""Features of parsed documents: the index record and the manifest row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselorn.functions import paths
from tesselorn.functions.fixed import HYPER_TRIG, IDENTITY_POST, NOT_VARIATIONS, VARIATIONS
from tesselorn.functions.lenient import NAN_TOKEN, above, below, greatest_abs, has_nan, to_float, to_int


def _names(attrs: Column) -> Column:
    return F.array_intersect(F.map_keys(attrs), F.array(*[F.lit(v) for v in VARIATIONS]))


def _post_symmetry(n: Column, k: Column) -> Column:
    return F.when(k > 1, n + k - 1).when(k < 0, n + 2 * F.abs(k) - 1).otherwise(n)


def records(parsed: DataFrame) -> DataFrame:
    """One row a document, all fields of the index; those that its kind lacks
    are null. ``parsed``: gen, sheep_id, content, sealed and the parse's columns."""
    g, a = F.col("genome"), F.col("genome.attrs")
    attr = lambda name, default="": F.coalesce(F.try_element_at(a, F.lit(name)), F.lit(default))
    of = lambda m, name: F.try_element_at(m, F.lit(name))
    xforms, final = F.col("genome.xforms"), F.get("genome.finals", F.lit(0))
    every = F.when(final.isNull(), xforms).otherwise(F.concat(xforms, F.array(final)))
    posted = lambda m: F.coalesce((F.length(of(m, "post")) > 0) & (F.regexp_replace(of(m, "post"), r"^\s+|\s+$", "") != IDENTITY_POST), F.lit(False))
    base = parsed.withColumns({"_every": every, "_final": final, "_counts": F.transform(xforms, lambda m: F.size(_names(m)))})
    e, counts = F.col("_every"), F.col("_counts")
    most = lambda arr: F.aggregate(arr, F.lit(0.0), lambda s, x: F.when(above(x, s), x).otherwise(s))
    affine = lambda m: F.greatest(
        F.when(of(m, "coefs").isNotNull(), greatest_abs(of(m, "coefs"))).otherwise(0.0),
        F.when(posted(m), greatest_abs(of(m, "post"))).otherwise(0.0),
    )
    kind = F.when(F.size("genome.symmetry") > 0, to_int(of(F.get("genome.symmetry", F.lit(0)), "kind"), "0"))
    genome = F.col("kind") == "genome"
    used = F.array_sort(F.array_distinct(F.flatten(F.transform(e, _names))))
    n = F.size(xforms)
    fields = {
        "name": attr("name"), "nick": attr("nick"), "url": attr("url"), "version": attr("version"), "dims": attr("size"),
        "rotate": to_float(attr("rotate", "0")), "brightness": to_float(attr("brightness", "4")),
        "palette_mode": attr("palette_mode", "step"), "filter_shape": attr("filter_shape", "gaussian"),
        "background": F.transform(F.filter(F.split(attr("background", "0 0 0"), r"\s+"), lambda t: t != ""), lambda t: to_float(t)),
        "supersample": to_int(attr("supersample", "1")), "highlight_power": to_float(attr("highlight_power", "-1")),
        "has_nan_camera": attr("center").rlike(NAN_TOKEN) | attr("scale").rlike(NAN_TOKEN),
        "has_density_estimator": above(to_float(attr("estimator_radius", "0")), 0),
        "gamma": to_float(attr("gamma", "4")), "vibrancy": to_float(attr("vibrancy", "1")),
        "estimator_minimum": to_float(attr("estimator_minimum", "0")), "estimator_curve": to_float(attr("estimator_curve", "0.4")),
        "has_symmetry": F.size("genome.symmetry") > 0, "symmetry_kind": kind,
        "xform_count": n, "has_final_xform": F.col("_final").isNotNull(),
        "has_post_affine": F.exists(e, posted), "has_xaos": F.exists(e, lambda m: F.map_contains_key(m, "chaos")),
        "has_nan_in_xforms": F.exists(e, has_nan),
        "negative_weight_xforms": F.size(F.filter(e, lambda m: below(to_float(of(m, "weight"), "1"), 0))),
        "variations": used, "xform_var_counts": counts, "max_var_per_xform": F.coalesce(F.array_max(counts), F.lit(0)),
        "mean_var_per_xform": F.when(n > 0, F.bround(F.aggregate(counts, F.lit(0), lambda s, x: s + x) / n, 2)).otherwise(0.0),
        "xforms_with_5plus_vars": F.size(F.filter(counts, lambda c: c >= 5)),
        "final_xform_var_count": F.when(F.col("_final").isNotNull(), F.size(_names(F.col("_final")))),
        "has_post_affine_per_xform": F.transform(xforms, posted),
        "max_xform_weight": most(F.transform(xforms, lambda m: to_float(of(m, "weight"), "1"))),
        "has_hyper_trig": F.arrays_overlap(used, F.array(*[F.lit(v) for v in HYPER_TRIG])), "has_edisc": F.array_contains(used, "edisc"),
        "max_abs_affine_coef": F.bround(most(F.transform(e, affine)), 6),
        "xform_count_post_symmetry": _post_symmetry(n, F.coalesce(kind, F.lit(0))),
    }
    return base.select(
        paths.record_id(F.col("gen"), F.col("sheep_id")).alias("id"), "gen", "sheep_id",
        F.coalesce(F.octet_length("content"), F.lit(0)).cast("long").alias("byte_size"), "kind", (F.col("kind") != "corrupt").alias("valid"),
        "frame_count", "error", *[F.when(genome, c).alias(k) for k, c in fields.items()], "sealed",
    )


def manifest(parsed: DataFrame, fetched_at: str, live_base: str, archive_base: str) -> DataFrame:
    """The 11 manifest columns of each document, with gen beside them."""
    flames, first = F.col("wrapped"), F.get("wrapped", F.lit(0))
    attr = lambda n: F.coalesce(F.try_element_at(first["attrs"], F.lit(n)), F.lit(""))
    ignored = F.array(*[F.lit(x) for x in NOT_VARIATIONS])
    names = F.flatten(F.transform(F.flatten(F.transform(flames, lambda f: f["xforms"])), lambda m: F.array_except(F.map_keys(m), ignored)))
    gen, sid = F.col("gen"), F.col("sheep_id")
    content = F.coalesce("content", F.lit(b""))
    return parsed.select(
        "gen", F.col("sheep_id").alias("id"), F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("file_size_bytes"),
        F.lit(fetched_at).alias("fetched_at"), paths.source_url(gen, sid, live_base, archive_base).alias("source_url"),
        attr("name").alias("name"), attr("nick").alias("nick"), attr("url").alias("url"),
        F.coalesce(F.size(first["xforms"]), F.lit(-1)).alias("xform_count"),
        F.coalesce(F.exists(flames, lambda f: f["final_below"]), F.lit(False)).alias("final_xform"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(names)), ";"), F.lit("")).alias("variations"),
    )
