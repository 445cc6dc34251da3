"""Exact top-k search: BM25 over an inverted index with block-max WAND.

Documents are indexed in shards of consecutive rows, stored in the shared
folder with the global document frequency of each of their terms (``counts``),
so scores use global statistics and the shards' top k merge exactly.

In a shard, documents lie by kind (clusters of their frequent words, in practice
languages) and size, and are cut into blocks; each term has a greatest impact,
and one for each of its blocks. A query with a threshold (its k-th score so far)
skips the shard if its terms' greatest impacts cannot reach it, and each block
whose summed block maxima cannot. A block's terms are of two sorts: those in many
of its documents, which have the lesser impacts, and rare ones. The frequent ones
are opened first, for many queries of a kind at once, as a matrix product. The
pivot then stands before the rare ones: where the best sum so far and their maxima
cannot reach the threshold, they stay closed. Else they are added, and documents
that may reach the threshold, by sums in single precision with a margin, are
scored exactly, which raises it for the next block. Ties go to the smaller id.

Shards are searched in rounds of growing size. The k-th scores of all rounds so
far go to the next one as thresholds, and from shard to shard within a task, so
that the rows that a round gives back are about as many as queries, times k.
Queries come in groups of a bounded size, which is what is broadcast.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesselorn.llm import counts
from tesselorn.llm.common import batch, drop, hashed, pack, pack_sorted, unpack, unpack_sorted, words_of, written

K1, B = 1.2, 0.75
#: Size of a shard: whichever comes first.
SHARD_DOCS = 1 << 14
SHARD_TOKENS = 3_000_000
#: Words that are hashed together, about.
WORD_BYTES = 1 << 24
BLOCK_BITS = 9
#: A term is frequent in a block if it is in this share of a block's documents;
#: at most so many are. A sum of so many in single precision is within MARGIN.
FREQUENT, FREQUENT_TERMS = 1 / 16, 4096
MARGIN = 1e-3
#: Queries, and their terms, that meet a block at once, about.
BATCH, BATCH_TERMS = 256, 1 << 16
#: Above this share of queries that stay, the others are not taken out of a batch.
DENSE = 0.8
#: Documents and queries are put in so many kinds, by their most frequent terms.
KINDS, KIND_TERMS = 8, 128
#: Queries in a row of the stored queries.
QUERY_BLOCK = 256
#: Terms and queries in a group, about: 12 MB of terms are broadcast, and the distinct ones.
GROUP_TERMS, GROUP_QUERIES = 3_000_000, 1 << 16
#: A round has so many times the shards of all before.
GROWTH = 4
#: Candidates of a query are cut by the k-th of their sums if they are more than this times k.
FEW = 3
#: Candidates that are scored at once.
EXACT = 256
#: Scores are compared at so many decimals, so that equal texts tie.
DECIMALS = 9
SLACK = 1e-6
#: Below the score of any document that has a query's word.
LEAST = 1e-30
#: Stands for a null id: behind all others.
LAST = (1 << 63) - 1

SHARD = pa.schema([("block", pa.string()), ("ids", pa.binary()), ("sizes", pa.binary()), ("terms", pa.binary()), ("starts", pa.binary()), ("docs", pa.binary()), ("tfs", pa.binary()), ("n", pa.int64()), ("tokens", pa.int64())])
SHARD_DDL = "block string, ids binary, sizes binary, terms binary, starts binary, docs binary, tfs binary, n long, tokens long"
FOUND = pa.schema([("number", pa.int64()), ("query_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())])
FOUND_DDL = "number long, query_id long, doc_id long, score double"


def kinds(terms: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """A kind for each of n texts, by the most frequent terms (numbers) that they
    have; text of[i] has terms[i]. Only speed depends on it."""
    out = np.zeros(n, np.int64)
    have = np.bincount(terms)
    best = np.argsort(-have, kind="stable")[:KIND_TERMS]
    number = np.full(len(have), -1)
    number[best] = np.arange(len(best))
    column = number[terms]
    x = np.zeros((n, len(best)), np.float32)
    x[of[column >= 0], column[column >= 0]] = 1
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    some = x[x.any(1)]
    if len(some) <= KINDS:
        return out
    some = some[:: -(-len(some) // 512)]
    centres = some[:1]
    for _ in range(KINDS - 1):  # far from the others, but no outlier
        far = np.argsort((some @ centres.T).max(1), kind="stable")[len(some) // 50]
        centres = np.vstack([centres, some[far : far + 1]])
    for _ in range(6):
        out = np.argmax(x @ centres.T, 1)
        centres = np.eye(KINDS, dtype=np.float32)[out].T @ x
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return out


def index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each shard: its inverted index, packed."""

    def fold(batches):
        ids_, sizes_, words_, coded, n, size = [], [], [], [], 0, 0

        def code() -> None:
            """Each distinct word is hashed once for many documents."""
            found = pa.concat_arrays(words_).dictionary_encode()
            coded.append((hashed(found.dictionary), found.indices.to_numpy()))
            words_.clear()

        def shard() -> pa.RecordBatch:
            nonlocal n, size
            if words_:
                code()
            ids, sizes = np.concatenate(ids_), np.concatenate(sizes_)
            terms = np.unique(np.concatenate([keys for keys, _ in coded]))
            which = np.concatenate([np.searchsorted(terms, keys).astype(np.int32)[at] for keys, at in coded])
            ids_.clear(), sizes_.clear(), coded.clear()
            n = size = 0
            of = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((sizes, kinds(which, of, len(sizes))))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            ids, sizes = ids[order], sizes[order]
            pairs, tfs = np.unique(which * np.int64(len(sizes)) + place[of], return_counts=True)
            df = np.bincount(pairs // len(sizes), minlength=len(terms))
            return batch(SHARD, block=[uuid.uuid4().hex], ids=[pack(ids.view(np.uint64))], sizes=[pack(sizes)], terms=[pack_sorted(terms)], starts=[pack(df)], docs=[pack(pairs % len(sizes))], tfs=[pack(tfs)], n=[len(sizes)], tokens=[int(sizes.sum())])

        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                words, sizes = words_of(part.column(1))
                ids_.append(part.column(0).fill_null(LAST).to_numpy())
                sizes_.append(sizes.astype(np.int64))
                words_.append(words)
                n, size = n + part.num_rows, size + int(sizes.sum())
                if n >= SHARD_DOCS or size >= SHARD_TOKENS:
                    yield shard()
                elif sum(w.nbytes for w in words_) > WORD_BYTES:
                    code()
        if n:
            yield shard()

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(fold, SHARD_DDL)


def query_blocks(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(number, queries, size, ids, sizes, terms): rows of queries, each with its
    distinct terms; size: terms in all."""
    schema = pa.schema([("queries", pa.int64()), ("size", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("terms", pa.binary())])

    def fold(batches):
        for b in batches:
            for at in range(0, b.num_rows, QUERY_BLOCK):
                part = b.slice(at, QUERY_BLOCK)
                words, sizes = words_of(part.column(1))
                h, ends = hashed(words), np.cumsum(sizes)
                terms = [np.unique(h[e - s : e]) for e, s in zip(ends, sizes)]
                size = np.array([len(t) for t in terms], np.uint64)
                ids = np.array(part.column(0).to_pylist(), np.int64)
                yield batch(schema, queries=[len(ids)], size=[int(size.sum())], ids=[pack(ids.view(np.uint64))], sizes=[pack(size)], terms=[pack(np.concatenate([np.zeros(0, np.uint64), *terms]))])

    plain = queries.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).where(F.col(f"`{id_col}`").isNotNull())
    return plain.mapInArrow(fold, "queries long, size long, ids binary, sizes binary, terms binary").withColumn("number", F.monotonically_increasing_id())


def runs(starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """All places from starts[i] up to starts[i + 1], for each i of ``which``."""
    return runs_of(starts[which], starts[which + 1] - starts[which])


def runs_of(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The n[i] places from lo[i] on, for each i."""
    upto = np.cumsum(n)
    return np.repeat(lo - upto + n, n) + np.arange(upto[-1] if len(n) else 0)


class Shard:
    """One shard's postings with impacts, of the terms in ``asked`` (sorted; None:
    all), and the search in it. ``opened`` counts the postings that searches
    looked at, ``all`` those of their terms, where all terms are kept."""

    def __init__(self, row, df: np.ndarray, documents: int, mean: float, bits: int, asked: np.ndarray | None = None):
        self.bits, self.opened, self.all, self.counting = bits, 0, 0, asked is None
        self.ids = unpack(row["ids"]).view(np.int64)
        self.terms = unpack_sorted(row["terms"])
        sizes = unpack(row["sizes"]).astype(np.float64)
        own = unpack(row["starts"]).astype(np.int64)
        docs, tf = unpack(row["docs"]).astype(np.int32), unpack(row["tfs"])
        if asked is not None:
            keep = np.isin(self.terms, asked, assume_unique=True)
            posts = np.repeat(keep, own)
            self.terms, own, df, docs, tf = self.terms[keep], own[keep], df[keep], docs[posts], tf[posts]
        idf = np.log(1 + (documents - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / max(mean, 1e-9))
        term = np.repeat(np.arange(len(own), dtype=np.int32), own)
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[docs])
        self.most = np.maximum.reduceat(impact, np.cumsum(own) - own) if len(own) else np.zeros(0)
        # by block, then term
        block = (docs >> bits).astype(np.uint16 if len(self.ids) <= 1 << 16 else np.int32)
        order = np.argsort(block, kind="stable")
        self.block_at = np.searchsorted(block[order], np.arange(((len(self.ids) - 1) >> bits) + 2))
        self.term, self.doc, self.impact = term[order], docs[order] & ((1 << bits) - 1), impact[order]
        # by document, then term
        order = np.argsort(docs.astype(np.uint16) if len(self.ids) <= 1 << 16 else docs, kind="stable")
        self.own_term, self.own_impact = term[order], impact[order]
        self.own_start = np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=len(self.ids)))])
        self.heavy = np.zeros(len(self.block_at) - 1)
        np.maximum.at(self.heavy, np.arange(len(self.ids)) >> bits, np.bincount(docs, impact, len(self.ids)))
        self.code = np.full(len(own), -1, np.int32)
        self.buffers = np.empty(0, np.int64), np.empty(0)
        self.asked = np.zeros(len(own) * max(1, min(16, (1 << 22) // max(len(own), 1))), bool)

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term here, -1 for those that are not."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def top(self, which: np.ndarray, k: int, low: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k documents that have any of the terms
        (numbers, ascending) and a score of at least ``low``."""
        best = {}
        self.search(which, np.array([0, len(which)]), k, np.array([low]), best, np.zeros(1, np.int64))
        return best.get(0, (np.zeros(0, np.int64), np.zeros(0)))

    def search(self, which: np.ndarray, ends: np.ndarray, k: int, low: np.ndarray, best: dict, order: np.ndarray) -> None:
        """Adds to ``best`` (ids and scores of each query) the documents here that
        have any of a query's terms and enter its best k with a score of at least
        ``low``, which rises. Terms of query i: which[ends[i]:ends[i + 1]],
        ascending. Queries come in ``order``. One that has no ``low`` yet opens
        the whole shard."""
        reach = np.concatenate([[0.0], np.cumsum(self.most[which])])
        reach = reach[ends[1:]] - reach[ends[:-1]] + SLACK
        order = order[((ends[1:] > ends[:-1]) & (reach >= low * (1 - 1e-9)))[order]]
        if not len(order):
            return
        upto, batches, first = np.cumsum(ends[order + 1] - ends[order]), [], 0
        while first < len(order):
            last = int(np.searchsorted(upto, (upto[first - 1] if first else 0) + BATCH_TERMS, side="right"))
            batch_ = order[first : max(first + 1, min(last, first + BATCH))]
            at = runs(ends, batch_)
            batches.append((batch_, low[batch_] > 0, which[at], np.repeat(np.arange(len(batch_), dtype=np.int32), ends[batch_ + 1] - ends[batch_])))
            first += len(batch_)
        for nth in range(len(self.block_at) - 1):
            lo, hi = self.block_at[nth : nth + 2]
            if hi > lo:
                self._block(nth, self.term[lo:hi], self.doc[lo:hi], self.impact[lo:hi], batches, k, low, best)

    def _block(self, nth, term, doc, impact, batches, k, low, best) -> None:
        width = 1 << self.bits
        start = np.flatnonzero(np.concatenate([[True], np.diff(term) != 0]))
        size, most = np.diff(np.append(start, len(term))), np.maximum.reduceat(impact, start)
        # terms by falling number of documents: codes 0 up to many are frequent
        rank = np.argsort(-size, kind="stable")
        start, size, terms, most = start[rank], size[rank], term[start[rank]], most[rank]
        many = min(int((size >= max(2, width * FREQUENT)).sum()), FREQUENT_TERMS)
        self.code[terms] = np.arange(len(terms), dtype=np.int32)
        at = runs_of(start[:many], size[:many])
        matrix = np.zeros((many, width), np.float32)
        matrix[np.repeat(np.arange(many), size[:many]), doc[at]] = impact[at]
        most32 = most[:many].astype(np.float32)
        rare = self._tables(start, size, doc, impact, many)
        for queries, known, which, of in batches:
            n = len(queries)
            level = np.maximum(low[queries] * (1 - MARGIN) - SLACK, LEAST)
            bound = np.where(known, level, LEAST)
            code = self.code[which]
            hit = np.flatnonzero(code >= 0)
            code, q = code[hit], of[hit]
            if self.counting:
                self.all += int(size[code].sum())
            reach = np.bincount(q, most[code], n)
            live = np.minimum(reach, self.heavy[nth] + SLACK) >= bound
            number = np.flatnonzero(live)
            if not len(number):
                continue
            if len(number) < n * DENSE:
                hit = np.flatnonzero(live[q])
                code, q = code[hit], (np.cumsum(live, dtype=np.int32) - 1)[q[hit]]
                level, bound, reach, n = level[number], bound[number], reach[number], len(number)
            else:
                level[~live], number = np.inf, np.arange(n)
            if self.counting:
                self.opened += int(size[code[(code < many) & np.isfinite(level[q])]].sum())
            place = code * n + q
            frequent = place < many * n
            has = np.zeros((many, n), np.float32)
            has.ravel()[place[frequent]] = 1
            sums = has.T @ matrix
            # the pivot stands before the rare terms, with the best sum of the others
            live = sums.max(1) + (reach - (1 - MARGIN) * (most32 @ has)) >= bound
            level[~live] = np.inf
            rest = np.flatnonzero(~frequent)
            code, q = code[rest], q[rest]
            if np.count_nonzero(live) < n * DENSE:
                hit = np.flatnonzero(live[q])
                code, q = code[hit], q[hit]
            if self.counting:
                self.opened += int(size[code[np.isfinite(level[q])]].sum())
            sums = self._added(code, q, rare, sums)
            found = np.flatnonzero(sums >= level[:, None])
            if not len(found):
                continue
            more = np.flatnonzero(np.bincount(found >> self.bits, minlength=n) > FEW * k)
            if len(more) and width > k:
                level[more] = np.maximum(level[more], np.partition(sums[more], -k, axis=1)[:, -k] * (1 - 2 * MARGIN) - SLACK)
                found = found[sums.ravel()[found] >= level[found >> self.bits]]
            self._enter(queries, which, of, number[found >> self.bits], (found & (width - 1)) + (nth << self.bits), k, low, best)
        self.code[terms] = -1

    def _tables(self, start, size, doc, impact, many) -> list:
        """Rare terms' postings in tables of a row for each term, those of about
        as many documents in one, filled up with impacts of 0: (first code, code
        after the last, documents, impacts)."""
        out, lo = [], many
        while lo < len(size):
            wide = int(size[lo])
            least = wide - wide // 4
            hi = int(np.searchsorted(-size, -least, side="right"))
            docs, impacts = np.zeros((hi - lo, wide), np.int64), np.zeros((hi - lo, wide))
            at = runs_of(start[lo:hi], size[lo:hi])
            slot = runs_of(np.arange(hi - lo) * wide, size[lo:hi])
            docs.ravel()[slot], impacts.ravel()[slot] = doc[at], impact[at]
            out.append((lo, hi, docs, impacts))
            lo = hi
        return out

    def _added(self, code, q, tables, sums) -> np.ndarray:
        """``sums`` with the postings of rare terms, in double precision."""
        key = code.astype(np.int64)
        key <<= 32
        key |= q
        key.sort()
        code = key >> 32
        q = key & 0xFFFFFFFF
        q <<= self.bits
        cuts = np.searchsorted(code, [lo for lo, *_ in tables] + [tables[-1][1]] if tables else [0])
        total = sum(int(b - a) * t[2].shape[1] for t, a, b in zip(tables, cuts, cuts[1:]))
        if len(self.buffers[0]) < total:
            self.buffers = np.empty(total, np.int64), np.empty(total)
        (at, weight), first = (x[:total] for x in self.buffers), 0
        for (lo, _, docs, impacts), a, b in zip(tables, cuts, cuts[1:]):
            if b > a:
                last = first + int(b - a) * docs.shape[1]
                own = code[a:b] - lo
                places = at[first:last].reshape(b - a, -1)
                np.take(docs, own, axis=0, out=places, mode="clip")
                places += q[a:b, None]
                np.take(impacts, own, axis=0, out=weight[first:last].reshape(b - a, -1), mode="clip")
                first = last
        return np.bincount(at, weight, sums.size).reshape(sums.shape) + sums

    def _exact(self, which: np.ndarray, of: np.ndarray, q: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of documents for queries (ascending), over the terms that these
        have: some queries' terms are marked at a time."""
        score, terms, some = np.empty(len(docs)), len(self.terms), np.unique(q)
        slots = len(self.asked) // terms
        for first in range(0, len(some), slots):
            own = some[first : first + slots]
            lo, hi = np.searchsorted(of, own), np.searchsorted(of, own, side="right")
            marks = np.repeat(np.arange(len(own)) * terms, hi - lo) + which[runs_of(lo, hi - lo)]
            self.asked[marks] = True
            begin, end = np.searchsorted(q, own[0]), np.searchsorted(q, own[-1], side="right")
            for a in range(begin, end, EXACT):
                d = docs[a : min(a + EXACT, end)]
                at = runs(self.own_start, d)
                pair = np.repeat(np.arange(len(d)), self.own_start[d + 1] - self.own_start[d])
                hit = np.flatnonzero(self.asked[(np.searchsorted(own, q[a : a + len(d)]) * terms)[pair] + self.own_term[at]])
                score[a : a + len(d)] = np.bincount(pair[hit], self.own_impact[at[hit]], len(d))
            self.asked[marks] = False
        return np.round(score, DECIMALS)

    def _enter(self, queries, which, of, q, docs, k, low, best) -> None:
        score = self._exact(which, of, q, docs)
        ok = score >= low[queries[q]]
        q, ids, score = q[ok], self.ids[docs[ok]], score[ok]
        first = np.flatnonzero(np.concatenate([[True], np.diff(q) != 0])) if len(q) else []
        for lo, hi in zip(first, np.append(first[1:], len(q))):
            query, own, points = int(queries[q[lo]]), ids[lo:hi], score[lo:hi]
            if query in best:
                own, points = np.concatenate([best[query][0], own]), np.concatenate([best[query][1], points])
            by = np.lexsort((own, -points))[:k]
            best[query] = own[by], points[by]
            if len(by) == k:
                low[query] = max(low[query], points[by[-1]])


class Group:
    """Some queries: ids, terms, the score that each has to reach, and an order
    by kind."""

    def __init__(self, rows):
        self.numbers = np.concatenate([np.arange(r["queries"], dtype=np.int64) + (r["number"] << 8) for r in rows])
        self.ids = np.concatenate([unpack(r["ids"]).view(np.int64) for r in rows])
        sizes = np.concatenate([unpack(r["sizes"]).astype(np.int64) for r in rows])
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, which = np.unique(np.concatenate([unpack(r["terms"]) for r in rows]), return_inverse=True)
        self.which = which.astype(np.int32)
        self.order = np.argsort(kinds(self.which, np.repeat(np.arange(len(sizes)), sizes), len(sizes)), kind="stable")
        self.low = np.zeros(len(self.ids))


def _searched(shards: DataFrame, group, k: int, n: int, mean: float) -> DataFrame:
    """(number, query_id, doc_id, score): for each task its best k for each query
    of ``group`` (broadcast) that reach the query's threshold."""

    def fold(batches):
        g: Group = group.value
        low, best = g.low.copy(), {}
        for b in batches:
            for row in range(b.num_rows):
                found = {c: b.column(c)[row].as_py() for c in ("ids", "sizes", "terms", "starts", "docs", "tfs", "df")}
                shard = Shard(found, unpack(found["df"]).astype(np.float64), n, mean, BLOCK_BITS, g.terms)
                place = shard.places(g.terms).astype(np.int32)[g.which]
                here = np.concatenate([[0], np.cumsum(place >= 0)])[g.ends]
                shard.search(place[place >= 0], here, k, low, best, g.order)
        for at in range(0, len(best), 4096):
            qs = list(best)[at : at + 4096]
            of = np.repeat(qs, [len(best[q][0]) for q in qs])
            yield batch(FOUND, number=g.numbers[of], query_id=g.ids[of], doc_id=np.concatenate([best[q][0] for q in qs]), score=np.concatenate([best[q][1] for q in qs]))

    return shards.mapInArrow(fold, FOUND_DDL)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _rounds(shards: int, parallel: int) -> list[float]:
    """Shares of the shards that all rounds up to each have."""
    out, share = [], parallel / max(shards, 1)
    while share < 0.5:
        out.append(share)
        share *= GROWTH
    return [*out, 1.0]


def _stored(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[float], int, float]:
    """The index with global document frequencies, by rounds; their shares; the
    number of documents and their mean size."""
    spark = docs.sparkSession
    shards = written(index(docs, id_col, text_col))
    size = shards.agg(F.count("*").alias("shards"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["tokens"] // counts.RANGE_KEYS))

    def ask(batches):
        for b in batches:
            for block, terms, df in zip(b["block"], b["terms"], b["starts"]):
                yield pd.DataFrame(counts.requests(block, unpack_sorted(terms), [unpack(df)], parts), columns=[x.split()[0] for x in counts.REQUEST.split(", ")])

    asked = shards.select("block", "terms", "starts").mapInPandas(ask, counts.REQUEST)
    replies = counts.replies(asked, parts).where("block <> ''").select("block", "part", "counts")
    rounds = _rounds(size["shards"], spark.sparkContext.defaultParallelism)
    names = [x.split()[0] for x in SHARD_DDL.split(", ")]

    def fold(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return left.assign(df=[pack(counts.answers(right, 0).view(np.uint64))] * len(left))

    # of each shard by a hash of its name: which round searches it
    at = F.pmod(F.xxhash64("block"), F.lit(1 << 20)) / (1 << 20)
    nth = sum((F.when(at >= x, 1).otherwise(0) for x in rounds[:-1]), F.lit(0))
    whole = shards.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(fold, f"{SHARD_DDL}, df binary")
    stored = written(whole.select(*names, "df", nth.cast("int").alias("round")), by="round")
    drop(shards)
    return stored, rounds, size["n"], size["tokens"] / max(size["n"], 1)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): the k documents of highest BM25 score for
    each query, ranks from 1, ties by smaller doc_id.

    Words are A-Z lower-cased runs of ``[^\\x20\\x09-\\x0D]``; each distinct word
    of a query counts once. Whole texts of all documents are indexed; a document
    without any of a query's words is no result, so empty queries have none.
    Null texts are empty; queries with a null id are left out; documents with one
    are indexed and come with a null doc_id. Repeated rows are documents, and
    queries, of their own. Other columns are not looked at. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    blocks = written(query_blocks(queries, id_col, text_col))
    # One row of three numbers for so many as QUERY_BLOCK queries.
    sizes = blocks.select("number", "queries", "size").orderBy("number").collect()
    groups, terms, asked = [], 0, 0
    for r in sizes:
        if not groups or terms + r["size"] > GROUP_TERMS or asked + r["queries"] > GROUP_QUERIES:
            groups.append([r["number"], r["number"]])
            terms = asked = 0
        groups[-1][1] = r["number"]
        terms, asked = terms + r["size"], asked + r["queries"]
    stored, rounds, n, mean = _stored(docs, id_col, text_col)
    done = []
    for first, last in groups:
        group, best = Group(blocks.where(F.col("number").between(first, last)).orderBy("number").collect()), None
        for nth in range(len(rounds)):
            shared = spark.sparkContext.broadcast(group)  # at most GROUP_TERMS, or one block of queries
            found = _searched(stored.where(F.col("round") == nth).drop("round"), shared, k, n, mean)
            now = written(_ranked(found if best is None else best.select(found.columns).unionByName(found), k))
            shared.unpersist()
            if best is not None:
                drop(best)
            best = now
            if nth + 1 < len(rounds):  # a number for each query of the group
                at = best.where(F.col("rank") == k).select("number", "score").toPandas()
                group.low[np.searchsorted(group.numbers, at["number"])] = at["score"]
        done.append(best)
    if not done:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    drop(stored, blocks)
    every = spark.read.schema(done[0].schema).parquet(*[t._tesselorn_path for t in done])
    return every.select("query_id", "rank", F.when(F.col("doc_id") < LAST, F.col("doc_id")).alias("doc_id"), "score")
