"""URL filters: a Bloom filter cascade gives exact membership without joins.

A rule is a host and a path prefix. A url's candidate keys are the ends of its
host that are as long as some rule's host and begin a label, each with each
prefix of its path that is as long as some rule's. Of the candidates that are
listed, the longest decides, of equally long ones that of the longest host.

Level 0 of a cascade holds the listed keys; level 1 the keys of the corpus that
level 0 wrongly passes; level 2 the listed keys that level 1 wrongly passes;
and so on until a level passes none. The first level that does not pass a key
decides on it: exactly, for every key of the corpus that it was built over.
All levels together take a few bits for each *listed* key (sizes follow the
number of listed keys; the corpus enters by a logarithm), so broadcasting them
is bounded by the rule list, not the data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselorn.llm.common import fresh, mixed

#: Rules above this number are refused: they are gathered on the driver, and
#: their filters would no longer be small.
MAX_RULES = 5_000_000


def host(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or end, A-Z lower-cased; null
    or no '://': empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to '?', '#' or end; null or no '://': empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidates(host_col: Column, path_col: Column, hosts: list[int], paths: list[int]) -> Column:
    """The keys of rules that could fit, longest first; ``hosts`` and ``paths``
    are the lengths that rules have. A long host costs as much as it is long for
    each length, however many labels it has."""
    size = F.length(host_col)
    begins = lambda n: (n == size) | ((n < size) & (F.substring(host_col, size - n, F.lit(1)) == "."))
    domains = F.transform(F.filter(F.array(*[F.lit(n) for n in hosts]), begins), lambda n: F.right(host_col, n))
    fitting = F.filter(F.array(*[F.lit(n) for n in paths]), lambda n: n <= F.length(path_col))
    key = lambda d, n: F.struct((F.length(d) + n).alias("n"), F.length(d).alias("host"), F.concat(d, F.substring(path_col, F.lit(1), n)).alias("key"))
    pairs = F.flatten(F.transform(domains, lambda d: F.transform(fitting, lambda n: key(d, n))))
    return F.reverse(F.array_sort(pairs))["key"]


def _bits(n: int, rate: float) -> tuple[int, int]:
    """Number of bits and hashes of a Bloom filter for n keys at a rate."""
    rate = min(max(rate, 1e-9), 0.5)
    m = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    return -(-m // 64) * 64, max(1, round(-math.log2(rate)))


class Level:
    """A Bloom filter over pairs of 64-bit hashes."""

    def __init__(self, number: int, n: int, rate: float):
        self.salt, (self.m, self.k) = np.uint64(number + 1), _bits(n, rate)
        self.words = np.zeros(self.m // 64, np.uint64)

    def places(self, h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            a, b = mixed(h[0] + self.salt), mixed(h[1] ^ (self.salt << np.uint64(17))) | np.uint64(1)
            return (a[:, None] + b[:, None] * np.arange(self.k, dtype=np.uint64)) % np.uint64(self.m)

    def add(self, h: np.ndarray) -> None:
        at = self.places(h).ravel()
        np.bitwise_or.at(self.words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))

    def passes(self, h: np.ndarray) -> np.ndarray:
        at = self.places(h)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).all(1)


class Cascade:
    """Alternating Bloom filters. Over no listed keys: no level, nothing listed."""

    def __init__(self):
        self.levels: list[Level] = []

    def listed(self, h: np.ndarray) -> np.ndarray:
        """Of each key of the corpus, whether it is listed. h: two rows of hashes."""
        out, open_ = np.full(h.shape[1], len(self.levels) % 2 == 1), np.arange(h.shape[1])
        for number, level in enumerate(self.levels):
            ok = level.passes(h[:, open_])
            out[open_[~ok]] = number % 2 == 1
            open_ = open_[ok]
        return out


def _pair(keys: pd.DataFrame) -> np.ndarray:
    return np.stack([keys["a"].to_numpy(np.int64), keys["b"].to_numpy(np.int64)]).view(np.uint64)


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b")]


def build(listed: DataFrame, universe: DataFrame, distinct: int) -> Cascade:
    """A cascade of the ``key`` column of ``listed`` that is exact over the
    ``key`` column of ``universe`` (repeats allowed, about ``distinct`` distinct
    keys). What level 0 wrongly passes is as many keys as are listed, about;
    these and the listed keys come to the driver, nothing else does. More than
    ``MAX_RULES`` listed keys are an error."""
    cascade = Cascade()
    own = listed.where("key is not null").select("key").distinct().select("key", *_hashes(F.col("key"))).limit(MAX_RULES + 1).toPandas()
    if len(own) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} listed keys")
    if own.empty:
        return cascade
    first = Level(0, len(own), math.sqrt(0.5) * len(own) / max(distinct, len(own)))
    first.add(_pair(own))
    cascade.levels.append(first)

    def wrongly(batches):
        for b in batches:
            yield b[first.passes(_pair(b))]

    passed = universe.where("key is not null").select("key", *_hashes(F.col("key"))).mapInPandas(wrongly, "key string, a long, b long")
    wrong = passed.distinct().toPandas()
    sides = [wrong[~wrong["key"].isin(own["key"])], own]
    while len(sides[0]):
        level = Level(len(cascade.levels), len(sides[0]), 0.5)
        level.add(_pair(sides[0]))
        cascade.levels.append(level)
        sides = [sides[1][level.passes(_pair(sides[1]))], sides[0]]
    return cascade


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule, verdict to ``pages``.

    ``rules``: (verdict, host, path prefix) with verdict allow or block. A rule
    fits its host and all subdomains if the url's path starts with its path; the
    longest fitting rule decides, of equally long ones that of the longest host,
    and is given as host + path. Without one, rule is null and the verdict is the
    cascades': a url with no key on the block list gets ``default``. Null and
    malformed urls have an empty host and path. Columns of ``pages`` with the new
    names are replaced, all others stay; repeated rows stay; an empty table gives
    an empty result. More than ``MAX_RULES`` rules of a verdict are an error.
    """
    names = {"allow": [h.lower() + p for v, h, p in rules if v == "allow"], "block": [h.lower() + p for v, h, p in rules if v == "block"]}
    if both := set(names["allow"]) & set(names["block"]):
        raise ValueError(f"both allowed and blocked: {sorted(both)}")
    spark = pages.sparkSession
    hosts, paths = (sorted({len(r[i]) for r in rules}) or [0] for i in (1, 2))
    url = F.col(f"`{url_col}`")
    keys = pages.select(F.explode(candidates(host(url), path(url), hosts, paths)).alias("key"))
    distinct = keys.agg(F.approx_count_distinct("key")).first()[0]
    block, allow = (build(spark.createDataFrame([(k,) for k in names[v]], "key string"), keys, distinct) for v in ("block", "allow"))

    @F.pandas_udf("array<int>")
    def states(a: pd.Series, b: pd.Series) -> pd.Series:
        sizes = a.map(len).to_numpy()
        h = np.stack([np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b)]).astype(np.int64).view(np.uint64)
        found = block.listed(h).astype(np.int32) + 2 * allow.listed(h).astype(np.int32)
        return pd.Series(np.split(found, np.cumsum(sizes)[:-1])) if len(sizes) else pd.Series([], dtype=object)

    second = lambda k: F.xxhash64(F.lit("second"), k)
    own_keys, own_states, own_hit = fresh(pages, "_keys", "_states", "_hit")
    out = pages.withColumns({"host": host(url), "path": path(url)})
    out = out.withColumn(own_keys, candidates(F.col("host"), F.col("path"), hosts, paths))
    out = out.withColumn(own_states, states(F.transform(own_keys, lambda k: F.xxhash64(k)), F.transform(own_keys, second)))
    hit = F.filter(F.arrays_zip(own_keys, own_states), lambda x: x[own_states] > 0)
    out = out.withColumn(own_hit, F.get(hit, F.lit(0)))
    state = F.col(own_hit)[own_states]
    verdict = F.when(state == 1, "block").when(state == 2, "allow").otherwise(F.lit(default))
    return out.withColumns({"rule": F.col(own_hit)[own_keys], "verdict": verdict}).drop(own_keys, own_states, own_hit)
