"""Global counts of hashed keys without a row per key.

Blocks of documents send their distinct keys, sorted and packed, to key
ranges; each range adds the counts of all blocks and answers each block in the
order of its keys. A key sends one entry a block, however often it occurs, so
no key is hot. Ranges are evenly filled, as keys are hashes.

The lowest bit of a key is a mark: totals (sums and numbers of distinct keys
with a count) are given over marked keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselorn.llm.common import joined, pack, pack_sorted, parted, unpack, unpack_sorted

REQUEST = "block string, part int, keys binary, counts binary"
REPLY = "block string, part int, counts binary, sums array<long>, kinds array<long>"
#: Keys that a range gets, about.
RANGE_KEYS = 2_000_000


def bounds(parts: int) -> np.ndarray:
    return np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)


def requests(block: str, keys: np.ndarray, counts: list[np.ndarray], parts: int) -> Iterator[dict]:
    """Rows of REQUEST for the sorted distinct keys of a block."""
    cuts = [0, *np.searchsorted(keys, bounds(parts)).tolist(), len(keys)]
    for part, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        if hi > lo:
            yield {"block": block, "part": part, "keys": pack_sorted(keys[lo:hi]), "counts": joined([pack(c[lo:hi]) for c in counts])}


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    keys = [unpack_sorted(k) for k in rows["keys"]]
    lists = [[unpack(p) for p in parted(c)] for c in rows["counts"]]
    kinds = len(lists[0])
    every = np.unique(np.concatenate(keys))
    sums = np.zeros((kinds, len(every)), np.int64)
    at = [np.searchsorted(every, k) for k in keys]
    for where, own in zip(at, lists):
        for i in range(kinds):
            sums[i][where] += own[i].astype(np.int64)
    marked = (every & np.uint64(1)).astype(bool)
    out = [
        {"block": b, "part": p, "counts": joined([pack(sums[i][where]) for i in range(kinds)]), "sums": None, "kinds": None}
        for b, p, where in zip(rows["block"], rows["part"], at)
    ]
    total = sums[:, marked]
    out.append({"block": "", "part": int(rows["part"].iloc[0]), "counts": None, "sums": total.sum(1).tolist(), "kinds": (total > 0).sum(1).tolist()})
    return pd.DataFrame(out)


def replies(asked: DataFrame, parts: int) -> DataFrame:
    """REPLY rows: the global counts of each request's keys, and for each key
    range a row of block '' with its totals."""
    return asked.repartition(parts, "part").groupBy("part").applyInPandas(_summed, REPLY)


def totals(answered: DataFrame, kinds: int) -> tuple[list[int], list[int]]:
    """Sums and numbers of distinct counted keys, for each kind of count."""
    row = answered.where(F.col("block") == "").agg(
        *[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).alias(f"s{i}") for i in range(kinds)],
        *[F.coalesce(F.sum(F.col("kinds")[i]), F.lit(0)).alias(f"k{i}") for i in range(kinds)],
    ).first()
    return [row[f"s{i}"] for i in range(kinds)], [row[f"k{i}"] for i in range(kinds)]


def answers(rows: pd.DataFrame, kind: int) -> np.ndarray:
    """One kind of count of a block's reply rows, along its sorted distinct keys."""
    lists = [unpack(parted(c)[kind]).view(np.int64) for c in rows.sort_values("part")["counts"]]
    return np.concatenate(lists) if lists else np.zeros(0, np.int64)
