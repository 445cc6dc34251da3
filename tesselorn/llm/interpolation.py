"""Deleted interpolation: an n-gram model mixed from maximum-likelihood
estimates of all orders and the uniform distribution.

P(w | history) = sum over k of weight[bucket][k] * count(k-gram) / count(its
history) + weight[bucket][0] / (V + 1). The bucket is the frequency class of
the histories: floor(log2(count + 1)) of each, longest first. A part of the
training documents is held out of the counts; expectation-maximisation over
its tokens learns the weights; the scores then use the counts of all training
documents.

Documents are cut into blocks of tokens, stored once in the shared folder.
Counts are exchanged between blocks and key ranges (``counts``); each block
scores its own documents, so a frequent n-gram makes no task longer.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselorn.llm import counts
from tesselorn.llm.common import NO_ID, batch, crc, drop, hashed, mixed, pack, pack_sorted, unpack, unpack_sorted, words_of, written

END = np.uint64(0xE0D0E0D0E0D0E0D0)
START = np.uint64(0x57A2757A2757A275)
ORDER = 2
BLOCK_TOKENS = 700_000
#: One in so many training documents is held out of the counts, for the weights.
HELD = 20
#: Rounds of expectation-maximisation go on until no weight moves by as much as
#: ``MOVED``; not to get there in ``ROUNDS`` is an error.
MOVED, ROUNDS = 1e-4, 1000

BLOCK = pa.schema([("block", pa.string()), ("held", pa.bool_()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("vocabulary", pa.binary()), ("tokens", pa.binary())])
BLOCK_DDL = "block string, held boolean, ids array<long>, sizes array<int>, vocabulary binary, tokens binary"


def trains(doc_id: int) -> bool:
    return crc(doc_id) % 5 != 1


def holds(doc_id: int) -> bool:
    """Whether a training document is held out of the counts for the weights."""
    return trains(doc_id) and crc(doc_id) // 5 % HELD == 0


def blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents as blocks of token numbers; held-out ones in blocks of their own."""

    def fold(batches):
        kept = {False: [], True: []}
        size = {False: 0, True: 0}

        def block(held: bool) -> pa.RecordBatch:
            ids, sizes, tokens = (np.concatenate([x[i] for x in kept[held]]) for i in range(3))
            vocabulary, where = np.unique(tokens, return_inverse=True)
            kept[held], size[held] = [], 0
            return batch(BLOCK, block=[uuid.uuid4().hex], held=[held], ids=[ids], sizes=[sizes], vocabulary=[pack_sorted(vocabulary)], tokens=[pack(where)])

        for b in batches:
            for rows in range(0, b.num_rows, 1000):
                part = b.slice(rows, 1000)
                words, sizes = words_of(part.column(1))
                ends = np.cumsum(sizes)
                tokens = np.insert(hashed(words), ends, END)  # an end after each text
                sizes = (sizes + 1).astype(np.int32)
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                held = np.array([holds(i) for i in ids], bool)
                for flag in (False, True):
                    if (held == flag).any():
                        kept[flag].append((ids[held == flag], sizes[held == flag], tokens[np.repeat(held == flag, sizes)]))
                        size[flag] += len(kept[flag][-1][2])
                        if size[flag] >= BLOCK_TOKENS:
                            yield block(flag)
        for flag in (False, True):
            if kept[flag]:
                yield block(flag)

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(fold, BLOCK_DDL)


def _order(row, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a block's k-grams, ascending, and for each token the
    number of the one that ends at it. Keys of 1-grams are odd, others even.
    Only one order's keys are in memory at a time."""
    vocabulary, tokens = unpack_sorted(row["vocabulary"]), unpack(row["tokens"]).view(np.int64)
    if k == 1:  # the vocabulary is sorted and distinct already, but for the scrambling
        keys = mixed(vocabulary) | np.uint64(1)
        order = np.argsort(keys)
        rank = np.empty(len(keys), np.int32)
        rank[order] = np.arange(len(keys))
        if (keys[order][1:] == keys[order][:-1]).any():  # two hashes that differ in the mark alone
            keys, again = np.unique(keys, return_inverse=True)
            return keys, again.astype(np.int32)[tokens]
        return keys[order], rank[tokens]
    place = _places(row)
    scrambled = mixed(vocabulary)
    back = scrambled[tokens]
    for j in range(1, k):
        before = np.where(place >= j, np.roll(vocabulary[tokens], j), START)
        with np.errstate(over="ignore"):
            back = mixed(back ^ (before * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j)))
    back &= ~np.uint64(1)
    order = np.argsort(back)
    back = back[order]
    new = np.concatenate([[True], back[1:] != back[:-1]])[: len(back)]
    which = np.empty(len(back), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return back[new], which


def _documents(row) -> np.ndarray:
    """Number of the document of each token."""
    return np.repeat(np.arange(len(row["sizes"]), dtype=np.int32), row["sizes"])


def _places(row) -> np.ndarray:
    """Place in its document of each token."""
    sizes = np.asarray(row["sizes"], np.int64)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _flags(row) -> tuple[np.ndarray, np.ndarray]:
    return np.array([trains(i) for i in row["ids"]], bool), np.array([holds(i) for i in row["ids"]], bool)


def _requests(table: DataFrame, order: int, parts: int) -> DataFrame:
    """Requests of each block, an order at a time; ``block`` ends in the order."""

    def ask(batches):
        for b in batches:
            for _, row in b.iterrows():
                train, held = _flags(row)
                doc = _documents(row)
                for k in range(1, order + 1):
                    every, which = _order(row, k)
                    kinds = [np.bincount(which, flags[doc], len(every)) for flags in (train, train & ~held)]
                    for asked in counts.requests(f"{row['block']}{k}", every, kinds, parts):
                        yield pd.DataFrame([asked])

    return table.mapInPandas(ask, counts.REQUEST)


def _answered(answered: DataFrame) -> DataFrame:
    """Replies with the order apart from the block's name."""
    own = answered.where("block <> ''")
    return own.withColumns({"block": F.substring("block", 1, 32), "order": F.substring("block", 33, 2).cast("int")})


def _seen(row, replies: pd.DataFrame, order: int, kind: int, documents: int):
    """Count of each token's k-gram and of its history, k from 1 to order."""
    place = _places(row)
    found = []
    for k in range(1, order + 1):
        answer = counts.answers(replies[replies["order"] == k], kind)
        found.append(answer[_order(row, k)[1]])
    histories = [np.where(place > 0, np.roll(found[k - 1], 1), documents) for k in range(1, order)]
    return found, histories


def bucket(histories: list[np.ndarray], n: int) -> np.ndarray:
    """Frequency class of the histories, the longest first."""
    out = np.zeros(n, np.int64)
    for h in reversed(histories):
        out = out * 64 + np.log2(h + 1).astype(np.int64)
    return out


def _held_counts(table: DataFrame, answered: DataFrame, order: int, documents: int) -> DataFrame:
    """(bucket, c1.., h2.., n): the tokens of the held-out documents, by what
    the kept counts say of them."""
    names = [f"c{k}" for k in range(1, order + 1)] + [f"h{k}" for k in range(2, order + 1)]

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or not left["held"].iloc[0]:
            return pd.DataFrame(columns=["bucket", *names, "n"])
        found, histories = _seen(left.iloc[0], right, order, 1, documents)
        rows = np.stack([bucket(histories, len(found[0])), *found, *histories])
        distinct, n = np.unique(rows, axis=1, return_counts=True)
        return pd.DataFrame(dict(zip(["bucket", *names, "n"], [*distinct, n])))

    ddl = ", ".join(f"{x} long" for x in ["bucket", *names, "n"])
    held = table.where("held")
    own = _answered(answered).join(held.select("block"), "block", "left_semi")
    return held.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(look, ddl).groupBy("bucket", *names).agg(F.sum("n").alias("n"))


def _fit(held: DataFrame, order: int, total: int, kinds: int) -> dict[int, list[float]]:
    """Weights of each bucket, by expectation-maximisation. A bucket's row is
    all that reaches the driver; there are at most 64 to the power order - 1."""
    parts = [f"1D / {kinds + 1}", f"c1 / {max(total, 1)}D", *(f"if(h{k} > 0, c{k} / double(h{k}), 0D)" for k in range(2, order + 1))]
    held = written(held.selectExpr("bucket", "n", *(f"{p} p{k}" for k, p in enumerate(parts))))
    sums = held.groupBy("bucket").agg(F.sum("n").alias("n"), *[F.max(f"p{k}").alias(f"p{k}") for k in range(order + 1)]).collect()
    can = {r["bucket"]: [k < 2 or r[f"p{k}"] > 0 for k in range(order + 1)] for r in sums}
    weights = {b: [x / sum(ok) for x in ok] for b, ok in can.items()}
    for nth in range(ROUNDS):
        table = held.sparkSession.createDataFrame([(b, *map(float, w)) for b, w in weights.items()], ", ".join(["bucket long", *(f"w{k} double" for k in range(order + 1))])) if weights else None
        if table is None:
            break
        share = held.join(F.broadcast(table), "bucket").withColumn("all", F.expr(" + ".join(f"w{k} * p{k}" for k in range(order + 1))))
        rows = share.groupBy("bucket").agg(*[F.sum(F.expr(f"n * w{k} * p{k} / all")).alias(f"e{k}") for k in range(order + 1)]).collect()
        # half a token more for the orders that every history has: no unseen word gets zero
        new = {}
        for r in rows:
            e = [r[f"e{k}"] + 0.5 * (k < 2) for k in range(order + 1)]
            new[r["bucket"]] = [x / sum(e) for x in e]
        moved = max((abs(a - b) for k in new for a, b in zip(new[k], weights[k])), default=0)
        weights = new
        if moved < MOVED:
            break
        if nth == ROUNDS - 1:
            raise RuntimeError(f"the weights still move by {moved} after {ROUNDS} rounds")
    drop(held)
    return weights


def _all_weights(weights: dict[int, list[float]], order: int):
    """Weights of any bucket: a bucket that no held-out token had takes those of
    the nearest known one with as many usable histories, else the uniform and
    1-gram ones."""
    known = sorted(weights)

    def of(b: int) -> list[float]:
        if b in weights:
            return weights[b]
        level = lambda x: [x // 64**i % 64 > 0 for i in range(order - 1)]
        near = [k for k in known if level(k) == level(b)]
        return weights[min(near, key=lambda k: (abs(k - b), k))] if near else [0.5, 0.5] + [0.0] * (order - 1)

    return of


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for each row of ``docs``.

    Training documents are those whose crc32(doc_id as text) mod 5 is not 1 (a
    null id counts as empty text). Tokens: A-Z lower-cased words and one end.
    base_score: add-half 1-gram log10 probability; score: the interpolated
    model's. Null and empty texts are one end token. Repeated rows count and are
    scored each. An empty table gives an empty result; with no training token
    all scores are uniform.
    """
    spark = docs.sparkSession
    table = written(blocks(docs, id_col, text_col))
    size = table.agg(F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size * order // counts.RANGE_KEYS))
    answered = written(counts.replies(_requests(table, order, parts), parts))
    (total, kept), (kinds, kept_kinds) = counts.totals(answered, 2)

    ids = table.select(F.explode("ids").alias("id"))
    crc32 = F.crc32(F.when(F.col("id") == NO_ID, "").otherwise(F.col("id").cast("string")).cast("binary"))
    is_train = crc32 % 5 != 1
    is_held = is_train & (F.floor(crc32 / 5) % HELD == 0)
    n = ids.agg(F.count_if(is_train).alias("all"), F.count_if(is_train & ~is_held).alias("kept")).first()
    weights = _fit(_held_counts(table, answered, order, n["kept"]), order, kept, kept_kinds)
    documents = n["all"]
    ddl = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame(columns=[x.split()[0] for x in ddl.split(", ")])
        row = left.iloc[0]
        found, histories = _seen(row, right, order, 0, documents)
        doc = _documents(row)
        base = np.log10((found[0] + 0.5) / (total + 0.5 * (kinds + 1)))
        own = bucket(histories, len(found[0]))
        there, at = np.unique(own, return_inverse=True)
        of = _all_weights(weights, order)
        w = np.array([of(int(b)) for b in there])[at].T
        p = w[0] / (kinds + 1) + w[1] * (found[0] / max(total, 1))
        for k in range(1, order):
            p += w[k + 1] * np.where(histories[k - 1] > 0, found[k] / np.maximum(histories[k - 1], 1), 0)
        train, _ = _flags(row)
        size = len(train)
        known = np.bincount(doc, found[0] > 0, size).astype(np.int64)
        return pd.DataFrame({"doc_id": pd.array([None if i == NO_ID else int(i) for i in row["ids"]], "Int64"), "held_out": ~train, "n_tokens": np.asarray(row["sizes"], np.int64), "n_known": known, "train_tokens": total, "base_score": np.bincount(doc, base, size), "score": np.bincount(doc, np.log10(p), size)})

    return table.groupBy("block").cogroup(_answered(answered).groupBy("block")).applyInPandas(sums, ddl)
