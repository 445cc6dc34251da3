"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are sorted by their rank in the reflected Gray code, in which
neighbours differ in few bits. Runs of neighbours form groups; the bits that
all members of a group share are kept once, in the node above, as mask and
pattern. A search goes down from the top, adds up the differing bits of the
masked patterns on its way, and leaves a whole group as soon as the sum is
beyond the radius.

The same index works on two levels: its top, over Gray-rank ranges of about
``RANGE_CODES`` distinct fingerprints each, sends a fingerprint to the ranges
that may hold a neighbour; its lower part, within a range, finds them. A range
gives back a spanning set of links, not all pairs. Copies share a fingerprint
and are one code; components are found by star contraction over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselorn.llm import common
from tesselorn.llm.common import as_bytes, batch, components, drop, hot_keys, join_hot, word_pieces, written

SEED = 42
SHINGLE = 3
RADIUS = 2
RANGE_CODES, LEAST_CODES = 1 << 16, 1 << 13
FAN = 16
#: Pairs of query and node that a search holds at once, about.
FRONTIER = 1 << 18


def gram_hashes(data: bytes, shingle: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of a text's shingles, repeats included, a piece of the text at a
    time; fewer words than a shingle: the whole sequence is one; no word: none."""
    one, carry, some = xxhash.xxh64_intdigest, [], False
    for words in word_pieces(data.lower()):
        words = carry + words
        if len(words) < shingle:
            carry = words
            continue
        some = True
        yield np.array([one(g, seed) for g in map(b" ".join, zip(*(words[i:] for i in range(shingle))))], np.uint64)
        carry = words[len(words) - shingle + 1 :]
    if carry and not some:
        yield np.array([one(b" ".join(carry), seed)], np.uint64)


def simhash(data: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text's UTF-8: bit set where over half of the shingle
    hashes have it; no word: zero."""
    seen, n = np.zeros(64, np.int64), 0
    for hashes in gram_hashes(data, shingle):
        n += len(hashes)
        for at in range(0, len(hashes), 1 << 15):
            part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
            seen += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(seen * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, code): the fingerprint of each whole text as a signed
    long, and the text's hash to find the row by where ids repeat. Null text
    counts as empty; a null id stays null; repeated rows stay."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("code", pa.int64())])

    def fold(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):  # few texts are held twice
                part = b.slice(at, 500)
                codes = np.array([simhash(t) for t in as_bytes(part.column(2))], np.uint64)
                yield batch(schema, doc_id=part.column(0), text_hash=part.column(1), code=codes.view(np.int64))

    return docs.select(F.col(id_col).cast("long"), F.xxhash64(text_col), F.col(text_col)).mapInArrow(fold, "doc_id long, text_hash long, code long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray code."""
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


def _rank(code: Column) -> Column:
    """The same on a long column, shifted so that signed order is rank order."""
    for s in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, s))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Index over entries with a pattern and the mask of its fixed bits."""

    def __init__(self, patterns: np.ndarray, masks: np.ndarray | None = None):
        full = np.full(len(patterns), ~np.uint64(0)) if masks is None else masks
        self.met = 0
        self.order = np.argsort(gray_rank(patterns), kind="stable")
        pattern, mask = (patterns & full)[self.order], full[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while len(pattern) > 1:
            starts = np.arange(0, len(pattern), FAN)
            every, some = np.bitwise_and.reduceat(pattern, starts), np.bitwise_or.reduceat(pattern, starts)
            shared = np.bitwise_and.reduceat(mask, starts) & ~(every ^ some)
            left = mask & ~np.repeat(shared, FAN)[: len(mask)]
            self.levels.append((pattern & left, left))
            pattern, mask = every & shared, shared
        self.levels.append((pattern, mask))

    def search(self, queries: np.ndarray, radius: int):
        """Yields arrays (query index, entry index) of all entries whose fixed
        bits differ from the query's in at most radius places."""
        todo = [np.arange(i, min(i + 1024, len(queries))) for i in range(0, len(queries), 1024)] if len(self.order) else []
        while todo:
            own = todo.pop()
            q, node, off = own, np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                pattern, mask = self.levels[depth]
                off = off + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
                near = off <= radius
                q, node, off = q[near], node[near], off[near]
                if depth:
                    if len(q) * FAN > FRONTIER and len(own) > 1:
                        todo += [own[: len(own) // 2], own[len(own) // 2 :]]
                        q = None
                        break
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    q, off = np.repeat(q, FAN), np.repeat(off, FAN)
                    there = node < len(self.levels[depth - 1][0])
                    q, node, off = q[there], node[there], off[there]
            if q is not None and len(q):
                yield q, self.order[node]

    def search_runs(self, queries: np.ndarray, radius: int):
        """The same for a wide radius, at which most groups stay for one query or
        another: queries go down in runs of their Gray order, and a group is left
        as soon as it is beyond the radius for a whole run. ``met`` counts the
        pairs of query and entry that were looked at."""
        if not len(self.order):
            return
        rank = np.argsort(gray_rank(queries), kind="stable")
        step = max(1, FRONTIER // len(self.order))
        for i in range(0, len(rank), step):
            own = rank[i : i + step]
            code, node, off = queries[own][:, None], np.zeros(1, np.int64), np.zeros((len(own), 1), np.uint8)
            for depth in range(len(self.levels) - 1, -1, -1):
                pattern, mask = self.levels[depth]
                differ = code ^ pattern[node]
                differ &= mask[node]
                off = off + np.bitwise_count(differ)
                near = off <= radius
                if depth:
                    kept = np.flatnonzero(near.any(axis=0))
                    node = (node[kept][:, None] * FAN + np.arange(FAN)).ravel()
                    there = int(np.searchsorted(node, len(self.levels[depth - 1][0])))
                    node, off = node[:there], np.repeat(off[:, kept], FAN, axis=1)[:, :there]
            self.met += near.size
            q, at = np.nonzero(near)
            if len(q):
                yield own[q], self.order[node[at]]


def _links(codes: DataFrame, radius: int) -> DataFrame | None:
    """(a, b): links between distinct codes that connect all that are within
    the radius. ``codes``: a written table with a row for each distinct code."""
    ranked = codes.select("code", _rank(F.col("code")).alias("rank"))
    n, parallel = codes.count(), codes.sparkSession.sparkContext.defaultParallelism
    # more and smaller ranges only as far as tasks would else be idle: a code goes to more of them
    ranges = max(-(-n // RANGE_CODES), min(2 * parallel, -(-n // LEAST_CODES)))
    cuts = np.zeros(0, np.int64)
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = np.unique(np.array(ranked.select(F.percentile_approx("rank", shares, max(10_000, 20 * ranges))).first()[0], np.int64))
    inside = pa.schema([("code", pa.int64()), ("part", pa.int32())])

    def assign(batches):
        for b in batches:
            yield batch(inside, code=b.column(0), part=np.searchsorted(cuts, b.column(1).to_numpy(), side="left").astype(np.int32))

    # One row a range: its number grows with the codes, by 1 in RANGE_CODES.
    tops = ranked.mapInArrow(assign, "code long, part int").groupBy("part").agg(F.bit_and("code").alias("every"), F.bit_or("code").alias("some")).collect()
    parts = np.array([t["part"] for t in tops], np.int32)
    every, some = (np.array([t[x] for t in tops], np.int64).view(np.uint64) for x in ("every", "some"))
    routed = pa.schema([("part", pa.int32()), ("code", pa.int64()), ("own", pa.bool_())])

    def route(batches):
        upper = GrayIndex(every, ~(every ^ some))
        for b in batches:
            code = b.column(0).to_numpy()
            home = np.searchsorted(cuts, b.column(1).to_numpy(), side="left").astype(np.int32)
            yield batch(routed, part=home, code=code, own=np.ones(len(code), bool))
            for q, at in upper.search(code.view(np.uint64), radius):
                on = parts[at] > home[q]  # each two ranges meet once
                yield batch(routed, part=parts[at[on]], code=code[q[on]], own=np.zeros(int(on.sum()), bool))

    pair = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(rows: pa.Table) -> pa.Table:
        code, own = rows["code"].to_numpy(), rows["own"].to_numpy()
        here, guests = code[own].view(np.uint64), code[~own].view(np.uint64)
        lower, label = GrayIndex(here), np.arange(len(here))
        for q, at in lower.search(here, radius):
            label = components(len(here), q, at, label)
        tied = label != np.arange(len(here))
        a, b = [here[tied]], [here[label[tied]]]
        for q, at in lower.search(guests, radius):
            x, y = guests[q], here[label[at]]
            order = np.lexsort((y, x))
            x, y = x[order], y[order]
            new = np.concatenate([[True], (np.diff(x) != 0) | (np.diff(y) != 0)])
            a.append(x[new])
            b.append(y[new])
        return pa.table([np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)], schema=pair)

    return ranked.mapInArrow(route, "part int, code long, own boolean").groupBy("part").applyInArrow(meet, "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """(node, root): for each node of the links (a, b) the smallest node that
    it reaches. Alternates large-star and small-star until nothing changes. A
    node with many links, a hub, is dealt to several tasks."""

    def star(edges: DataFrame, large: bool, n: int) -> DataFrame:
        # each node with its neighbours: both ways (large), or the smaller ones
        if large:
            near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"), F.count("*").alias("n"))
        hubs = hot_keys(least, ["a"]) if n > common.HOT_ROWS else []
        out = join_hot(near, least.drop("n"), "a", hubs)
        if large:
            return out.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        return out.select(F.col("b").alias("x"), "least", "a").select(F.explode(F.array("x", "a")).alias("a"), F.col("least").alias("b")).where("a <> b").distinct()

    mark = lambda e: e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    edges = written(links.where("a <> b").distinct())
    before = mark(edges)
    while before[0]:
        after = written(star(star(edges, True, before[0]), False, before[0]))
        drop(edges)
        edges, now = after, mark(after)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, code, component_id) for each row of ``fingerprints``: documents
    link where codes differ in at most ``radius`` bits; component_id is the
    smallest doc_id reached, itself included. Null ids take part in links but
    are never the smallest; a component of null ids alone has a null id.
    An empty table gives an empty result."""
    prints = written(prints)
    codes = written(prints.groupBy("code").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = connected(_links(codes, radius))
    rooted = written(codes.join(roots, codes["code"] == roots["node"], "left").select("code", "least", "n", F.coalesce("root", "code").alias("root")))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    labels = written(join_hot(rooted.drop("n"), groups.drop("n"), "root", hot_keys(groups, ["root"])).select("code", "component_id"))
    drop(rooted)
    return join_hot(prints, labels, "code", hot_keys(codes, ["code"])).select("doc_id", "text_hash", "code", "component_id")


def as_hex(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")
