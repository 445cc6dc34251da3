"""The registered queries of the engine and their SQL oracles.

Documents are made from the relational tables (``synth``), written as XML and
parsed again; the oracles compute the expected features from the tables alone.
Texts come out as their SHA-256, arrays as joined strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselorn.functions import paths
from tesselorn.functions.fixed import FILE_PREFIX, LIVE_GENS
from tesselorn.operators import delivery, features, ingest, layout, parse, recipes, stats
from tesselorn.plans import expected, synth
from tesselorn.sources.tables import table


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(gen, sheep_id) of all orders."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select((240 + key % 10).cast("int").alias("gen"), key.alias("sheep_id"))


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(gen, sheep_id) remembered as absent: customers' numbers beyond the orders'."""
    return table(spark, sf_dir, "customer").select((240 + F.col("c_custkey") % 10).cast("int").alias("gen"), (F.col("c_custkey") * 10 + F.col("c_custkey") % 10).alias("sheep_id"))


def _of(fold):
    """A query of index records, from their table."""
    return lambda spark, sf_dir: fold(synth.stored_records(spark, sf_dir))


def _hashed(texts: DataFrame) -> DataFrame:
    return texts.select("gen", "sheep_id", F.sha2(F.col("xml").cast("binary"), 256).alias("sha256"))


def storage_bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir).groupBy("gen", paths.bucket(F.col("sheep_id")).alias("bucket")).agg(F.count("*").alias("documents"))


def delivery_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = paths.window_name(F.col("gen"), F.col("sheep_id")).alias("window")
    return _ids(spark, sf_dir).groupBy(name).agg(F.count("*").alias("documents"), F.min("sheep_id").alias("min_id"), F.max("sheep_id").alias("max_id"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name and address of a document, and the name parsed again."""
    gen, sid = F.col("gen"), F.col("sheep_id")
    named = _ids(spark, sf_dir).select("gen", "sheep_id", paths.file_name(gen, sid).alias("name"), paths.file_path(gen, sid, "corpus").alias("path"), paths.record_id(gen, sid).alias("id"), paths.source_url(gen, sid, expected.LIVE_BASE, expected.ARCHIVE_BASE).alias("url"))
    back_gen, back_id = paths.parsed_name(F.col("name"))
    return named.withColumns({"name_gen": back_gen, "name_id": back_id})


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text, 256).alias("sha256"), F.octet_length(text).cast("long").alias("bytes"))


def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.first_wins(content_hash(spark, sf_dir), ["sha256"], ["doc_id"])


def avail_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.deltas(_ids(spark, sf_dir))


def avail_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.listed(delivery.id_lists(_ids(spark, sf_dir)))


def gens_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.generations(_ids(spark, sf_dir))


RANGE = (0, 50_000)


def missing_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.gaps(spark, 247, *RANGE, _ids(spark, sf_dir), _missing(spark, sf_dir))


def fetch_plan_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.plan(spark, 248, *RANGE, _ids(spark, sf_dir), _missing(spark, sf_dir)).groupBy("outcome").agg(F.count("*").alias("ids"))


def corpus_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.status(_ids(spark, sf_dir), _missing(spark, sf_dir))


def import_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an import of one generation would add: customers as the source."""
    source = table(spark, sf_dir, "customer").select(F.lit(244).alias("gen"), F.col("c_custkey").alias("sheep_id"))
    return ingest.imported(source, _ids(spark, sf_dir), 244)


def _counts(ids: DataFrame, missing: DataFrame) -> DataFrame:
    return layout.counts(ids, missing)


def _shrunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _ids(spark, sf_dir)
    return _counts(ids.where("gen <> 243 and not (gen = 245 and sheep_id % 3 = 0)"), _missing(spark, sf_dir).where("gen <> 246"))


def baseline_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.drift(_counts(_ids(spark, sf_dir), _missing(spark, sf_dir)), _shrunk(spark, sf_dir), ["loose_count", "missing_count", "bucket_count"])


def total_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.total_drift(_counts(_ids(spark, sf_dir), _missing(spark, sf_dir)), _shrunk(spark, sf_dir), ["loose_count", "missing_count"])


def archive_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' texts as an archive against a manifest with planted faults."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    manifest = docs.where("id % 7 <> 1").select("id", F.when(F.col("id") % 5 == 2, F.lit("0")).otherwise(F.sha2("content", 256)).alias("sha256"), (F.octet_length("content") + F.when(F.col("id") % 11 == 3, 1).otherwise(0)).alias("file_size_bytes"))
    return ingest.mismatches(docs.where("id % 13 <> 4"), manifest)


def relayout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in buckets of a thousand and, in part, in buckets of ten thousand."""
    gen, sid = F.col("gen"), F.col("sheep_id")
    ids = _ids(spark, sf_dir)
    old = ids.select(F.concat_ws("/", gen.cast("string"), F.format_string("%02dxxx", F.floor(sid / 1000)), paths.file_name(gen, sid)).alias("path"))
    new = ids.where("sheep_id % 4 = 0").select(F.concat_ws("/", gen.cast("string"), paths.bucket(sid), paths.file_name(gen, sid)).alias("path"))
    return layout.moves(old.unionByName(new))


def migrate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What re-laying these files out does, by generation."""
    return layout.move_counts(relayout(spark, sf_dir).select("path", "target", "action", "gen", "sheep_id"))


def flat_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of which a part lies flat at its generation's root, some in others'."""
    gen, sid = F.col("gen"), F.col("sheep_id")
    folder = F.when(sid % 7 == 0, F.concat_ws("/", gen, paths.file_name(gen, sid))).when(sid % 7 == 1, F.concat_ws("/", gen + 1, paths.file_name(gen, sid))).otherwise(F.concat_ws("/", gen, paths.bucket(sid), paths.file_name(gen, sid)))
    return ingest.flat_residue(_ids(spark, sf_dir).where("gen <> 246").select(folder.alias("path")))


def chunk_member_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.member_names(_ids(spark, sf_dir))


def artifact_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    gens = [r["gen"] for r in _ids(spark, sf_dir).select("gen").distinct().collect()]
    rows = [(g, paths.gen_zip_name(g, "2026-01-02"), paths.undated_zip_path(g, "x")[2:], paths.mega_name("2026-01-02"), paths.chunks_name("2026-01-02")) for g in gens]
    return spark.createDataFrame(rows, "gen int, zip string, undated_zip string, bundle string, chunks string")


def gather_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as copies of an order, a third of them sealed: which copy an
    index takes (the first loose path) and which a release (the last one)."""
    sealed = F.col("l_partkey") % 3 == 0
    copies = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sheep_id"), sealed.alias("sealed"), F.format_string("%d/%06d/%06d", "l_linenumber", "l_partkey", "l_suppkey").alias("path"))
    first, last = layout.winners(copies, ["sheep_id"]), layout.winners(copies, ["sheep_id"], last=True)
    return first.select("sheep_id", F.col("sealed").alias("first_sealed"), F.col("path").alias("first_path")).join(last.select("sheep_id", F.col("sealed").alias("last_sealed"), F.col("path").alias("last_path")), "sheep_id")


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.manifest(parse.parsed(synth.documents(spark, sf_dir), genome=False), expected.FETCHED_AT, expected.LIVE_BASE, expected.ARCHIVE_BASE)


def document_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.checked(synth.documents(spark, sf_dir).select("gen", "sheep_id", "content")).select("gen", "sheep_id", "valid")


def page_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages are no documents."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    return parse.checked(pages).select("page_id", "valid")


def index_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of the index; arrays as joined texts."""
    r = synth.records(spark, sf_dir).drop("scan_seq")
    return r.select(*[F.array_join(F.transform(f.name, lambda x: x.cast("string")), ",").alias(f.name) if f.dataType.typeName() == "array" else f.name for f in r.schema.fields])


def corpus_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.corpus_shape(synth.shapes(spark, sf_dir))


def genome_only_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = synth.documents(spark, sf_dir)
    return _hashed(delivery.served(raw, features.records(parse.parsed(raw, wrapped=False))))


def chunk_bodies_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(delivery.unpacked(delivery.windows(delivery.readable(synth.documents(spark, sf_dir)))))


IDS = "with i as (select (240 + o_orderkey % 10)::int as gen, o_orderkey as k from orders), miss as (select distinct (240 + c_custkey % 10)::int as gen, c_custkey * 10 + c_custkey % 10 as k from customer)"
NAME = f"printf('{FILE_PREFIX}.%d.%05d.flam3', gen, k)"
BUCKET = "printf('%05d', k // 10000 * 10000)"
DOC = "encode(coalesce(text, ''))"
_LIVE = ", ".join(map(str, LIVE_GENS))
_OUTCOMES = IDS + f", o as (select k.range as k, case when k.range in (select k from i where gen = {{gen}}) then 'local' when k.range in (select k from miss where gen = {{gen}}) then 'known_missing' else 'fetch' end as outcome from range({RANGE[0]}, {RANGE[1]}) k)"
_DRIFT = IDS + """
, b as (select gen, count(*) as loose_count, count(distinct k // 10000) as bucket_count from i group by gen)
, bm as (select gen, count(*) as missing_count from miss group by gen)
, n as (select gen, count(*) as loose_count, count(distinct k // 10000) as bucket_count from i where gen <> 243 and not (gen = 245 and k % 3 = 0) group by gen)
, nm as (select gen, count(*) as missing_count from miss where gen <> 246 group by gen)
, base as (select gen, coalesce(loose_count, 0) as l, coalesce(missing_count, 0) as m, coalesce(bucket_count, 0) as k from b full join bm using (gen))
, now as (select gen, coalesce(loose_count, 0) as l, coalesce(missing_count, 0) as m, coalesce(bucket_count, 0) as k from n full join nm using (gen))
, p as (select base.gen, base.l, base.m, base.k, coalesce(now.l, 0) as nl, coalesce(now.m, 0) as nm, coalesce(now.k, 0) as nk from base left join now using (gen))
"""

#: name: (query, SQL)
QUERIES = {
    "storage_bucket_counts": (storage_bucket_counts, IDS + f" select gen, {BUCKET} as bucket, count(*) as documents from i group by 1, 2"),
    "delivery_windows": (delivery_windows, IDS + " select printf('%d/%05d.flam3chunk', gen, k // 256 * 256) as \"window\", count(*) as documents, min(k) as min_id, max(k) as max_id from i group by 1"),
    "file_names": (file_names, IDS + f" select gen, k as sheep_id, {NAME} as name, 'corpus/' || gen || '/' || {BUCKET} || '/' || {NAME} as path, printf('%d/%05d', gen, k) as id, case when gen in ({_LIVE}) then printf('{expected.LIVE_BASE}/gen/%d/%d/', gen, k) || {NAME} else printf('{expected.ARCHIVE_BASE}/generation-%d/%d/spex', gen, k) end as url, gen as name_gen, k as name_id from i"),
    "content_hash": (content_hash, f"select doc_id, sha256({DOC}) as sha256, octet_length({DOC}) as bytes from documents"),
    "first_wins_dedup": (first_wins_dedup, f"select min(doc_id) as doc_id, sha256({DOC}) as sha256, octet_length({DOC}) as bytes from documents group by 2, 3"),
    "gens_summary": (gens_summary, IDS + ' select gen, count(*) as "count", min(k) as min_id, max(k) as max_id from i group by gen'),
    "avail_deltas": (avail_deltas, IDS + " select gen, k as sheep_id, k - lag(k, 1, 0) over (partition by gen order by k) as delta from (select distinct * from i)"),
    "avail_roundtrip": (avail_roundtrip, IDS + " select distinct gen, k as sheep_id from i"),
    "missing_gaps": (missing_gaps, _OUTCOMES.format(gen=247) + " select k as sheep_id from o where outcome = 'fetch'"),
    "fetch_plan_outcomes": (fetch_plan_outcomes, _OUTCOMES.format(gen=248) + " select outcome, count(*) as ids from o group by outcome"),
    "corpus_status": (corpus_status, IDS + " select gen, coalesce(a, 0) as loose_count, coalesce(b, 0) as missing_count from (select gen, count(*) as a from i group by gen) full join (select gen, count(*) as b from miss group by gen) using (gen)"),
    "import_new": (import_new, IDS + " select 244 as gen, c_custkey as sheep_id from customer where c_custkey not in (select k from i where gen = 244)"),
    "baseline_drift": (baseline_drift, _DRIFT + "select gen, 'loose_count' as what, l as expected, nl as actual from p where nl < l union all select gen, 'missing_count', m, nm from p where nm < m union all select gen, 'bucket_count', k, nk from p where nk < k"),
    "total_drift": (total_drift, _DRIFT + "select gen, 'total' as what, l + m as expected, nl + nm as actual from p where nl + nm < l + m"),
    "archive_mismatches": (archive_mismatches, "select doc_id as id, case when doc_id % 13 = 4 then 'not in the archive' when doc_id % 7 = 1 then 'not in the manifest' when doc_id % 11 = 3 then 'size' else 'sha256' end as problem from documents where case when doc_id % 13 = 4 then doc_id % 7 <> 1 else doc_id % 7 = 1 or doc_id % 11 = 3 or doc_id % 5 = 2 end"),
    "relayout": (relayout, IDS + f", f as (select gen || '/' || printf('%02dxxx', k // 1000) || '/' || {NAME} as path, gen || '/' || {BUCKET} || '/' || {NAME} as target, case when k % 4 = 0 then 'superseded' else 'move' end as action, gen, k as sheep_id from i union all select gen || '/' || {BUCKET} || '/' || {NAME}, gen || '/' || {BUCKET} || '/' || {NAME}, 'keep', gen, k from i where k % 4 = 0) select * from f"),
    "migrate_counts": (migrate_counts, IDS + " select gen, count(*) filter (where k % 4 <> 0) as moved, count(*) filter (where k % 4 = 0) as already_chunked, count(*) filter (where k % 4 = 0) as superseded, count(distinct k // 10000) as bucket_count from i group by gen"),
    "flat_residue": (flat_residue, IDS + " select gen, 'flat_files' as what, 0::bigint as expected, count(*) as actual from i where gen <> 246 and k % 7 = 0 group by gen"),
    "chunk_member_names": (chunk_member_names, IDS + " select 'gens.json' as name union all select distinct gen || '/avail.flam3idx' from i union all select distinct printf('%d/%05d.flam3chunk', gen, k // 256 * 256) from i"),
    "manifest_rows": (manifest_rows, expected.MANIFEST),
    "document_check": (document_check, expected.VALID),
    "page_check": (page_check, "select page_id, false as valid from pages"),
    "index_records": (index_records, expected.RECORDS),
    "index_summary": (_of(stats.summary), expected.SUMMARY),
    "corpus_shape": (corpus_shape, expected.SHAPE),
    "variation_histogram": (_of(stats.variation_histogram), expected.HISTOGRAM),
    "structural_features": (_of(stats.structural), expected.STRUCTURAL),
    "safety_features": (_of(stats.safety), expected.SAFETY),
    "tonemap_nondefault": (_of(stats.tone_map), expected.TONE),
    "version_top10": (_of(stats.versions), expected.VERSIONS),
    "malformations_by_gen": (_of(stats.malformations), expected.MALFORMATIONS),
    "xform_histogram": (_of(stats.xform_histogram), expected.XFORMS),
    "var_density": (_of(stats.density), expected.DENSITY),
    "dense_genomes": (_of(stats.dense_genomes), expected.DENSE),
    "frame_bins": (_of(stats.frame_bins), expected.FRAMES),
    "corrupt_errors": (_of(stats.corrupt_errors), expected.ERRORS),
    "recipe_variation": (_of(lambda r: recipes.with_variation(r, "bipolar")), expected.ids("list_contains(used, 'bipolar')")),
    "recipe_variation_head": (_of(lambda r: recipes.head(recipes.with_variation(r, "bipolar"))), expected.ids("list_contains(used, 'bipolar') order by seq limit 10")),
    "recipe_gpu_safe": (_of(recipes.gpu_safe), expected.ids(expected.SAFE)),
    "recipe_parity": (_of(recipes.parity), expected.ids(expected.PARITY + " and fv is not null")),
    "recipe_parity_any": (_of(lambda r: recipes.parity(r, final=False)), expected.ids(expected.PARITY)),
    "recipe_symmetry": (_of(recipes.by_symmetry), expected.SYMMETRY),
    "recipe_low_complexity": (_of(recipes.low_complexity), expected.ids("n <= 2 and not xaos")),
    "recipe_tonal": (_of(recipes.tonal), expected.TONAL),
    "recipe_lookup": (_of(lambda r: recipes.lookup(r, "246/00006").select("id", "kind", "frame_count")), expected.LOOKUP),
    "recipe_without_nan": (_of(recipes.without_nan), expected.ids("not nanc and not nanx")),
    "recipe_rare_variations": (_of(recipes.rare_variations), expected.RARE),
    "recipe_dense": (_of(recipes.dense), expected.DENSEST),
    "recipe_envelope": (_of(lambda r: recipes.envelope(r, "2026-01-02")), "select 6 as _schema_version, '2026-01-02' as _build_date"),
    "artifact_names": (artifact_names, IDS + " select gen, 'gen-' || gen || '-2026-01-02.zip' as zip, 'gen-' || gen || '.zip' as undated_zip, 'corpus-all-2026-01-02.tar.xz' as bundle, 'corpus-chunks-2026-01-02.tar' as chunks from (select distinct gen from i)"),
    "gather_winners": (gather_winners, "with c as (select l_orderkey as sheep_id, l_partkey % 3 = 0 as sealed, printf('%d/%06d/%06d', l_linenumber, l_partkey, l_suppkey) as path from lineitem), w as (select sheep_id, bool_and(sealed) as none, min(path) filter (where not sealed) as lo, max(path) filter (where not sealed) as hi, min(path) as any_path from c group by 1) select sheep_id, none as first_sealed, case when none then any_path else lo end as first_path, none as last_sealed, case when none then any_path else hi end as last_path from w"),
    "genome_only_served": (genome_only_served, expected.SERVED),
    "chunk_bodies_roundtrip": (chunk_bodies_roundtrip, expected.TEXTS),
}


def queries() -> dict:
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
