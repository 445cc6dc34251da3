"""The subpackage's registered queries: thin, over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselorn.llm import interpolation, linededup, mixing, pieces, quality, search, simhash, spotsigs, urlfilter, viterbi

#: Rules of the op1 contract: verdict, host, path prefix.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
with u as (
  select page_id, coalesce(url, '') as url from pages
), h as (
  select page_id,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from u
), r(verdict, rule_host, rule_path) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), m as (
  select h.page_id, r.verdict, rule_host || rule_path as rule,
    row_number() over (partition by h.page_id order by length(rule_host || rule_path) desc) as nth
  from h join r on (h.host = rule_host or ends_with(h.host, '.' || rule_host)) and starts_with(h.path, rule_path)
)
select h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') as verdict
from h left join m on m.page_id = h.page_id and m.nth = 1
"""


def op2_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(_table(spark, sf_dir, "documents"))


def op3_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


#: Wanted shares of tokens of the domains that the labels define. Rates of good
#: documents stay at 1 or above, as the share of the bad falls.
TARGETS = {"good": 0.97, "poor": 0.03, "toxic": 0.0}


def label_domains(labels: DataFrame) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), label_domains(_table(spark, sf_dir, "labels")), TARGETS)
    return mixed.drop("text_hash")


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_pairs(_table(spark, sf_dir, "documents"))


def op6_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return search.search(docs, docs.where(F.col("doc_id") % 100 == 0))


def op8_count_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.token_counts(_table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"))


def op10_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(simhash.fingerprints(_table(spark, sf_dir, "documents")))
    return found.select("doc_id", simhash.as_hex(F.col("code")).alias("fingerprint"), "component_id")


def queries() -> dict:
    return {
        "op1_bloom_cascade": op1_bloom_cascade,
        "op2_deleted_interpolation": op2_deleted_interpolation,
        "op3_line_winnowing": op3_line_winnowing,
        "op4_soft_mixing": op4_soft_mixing,
        "op5_spotsigs": op5_spotsigs,
        "op6_factorisation_machine": op6_factorisation_machine,
        "op7_block_max_wand": op7_block_max_wand,
        "op8_count_viterbi": op8_count_viterbi,
        "op9_sentencepiece": op9_sentencepiece,
        "op10_simhash_gray": op10_simhash_gray,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_bloom_cascade": OP1_SQL}
