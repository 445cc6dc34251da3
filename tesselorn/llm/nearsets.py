"""Near-duplicates by shingle sets: SimHash candidates, exact Jaccard.

The pipeline's stage. A text is the set of its five-word shingles; texts of
equal sets are one node. Candidates are nodes whose sizes allow a Jaccard index
of ``LEAST``, whose fingerprints lie within ``RADIUS`` bits and of whose eight min-hash bytes ``SAME`` agree. Only nodes that have a
candidate bring their sets along; pairs are then decided by the sets themselves.

Set sizes are cut into classes a factor of 1 / ``LEAST`` wide, so partners are in
the same class or the next. A class is dealt to blocks by hash, so that blocks
are even, and each two blocks meet once: at this radius no range of the Gray
order could be left out. In a meeting one block's fingerprints are searched for
in the Gray index of the other's, which goes down by runs of neighbours. Few of
its groups are beyond the radius for a whole run (1 % or none on random codes
and on clusters of them), so the work stays the square of a class, and the rows
sent are whole blocks. A meeting gives back a spanning set of the links it verified.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselorn.llm.common import as_bytes, batch, drop, hot_keys, join_hot, mixed, written
from tesselorn.llm.simhash import GrayIndex, connected, gram_hashes

SHINGLE = 5
LEAST = 0.8
#: Of 64 bits, 9.7 +- 2.9 differ at a Jaccard index of 0.8.
RADIUS = 16
#: The same for sets of fewer than ``FEW``, where ties of bits add to it.
RADIUS_FEW, FEW = 24, 20
#: Of eight min-hashes 6.4 +- 1.1 agree at a Jaccard index of 0.8.
SAME = 3
#: Nodes in a block, least and most; and shingles in a block of sets, about.
BLOCK = (2048, 1 << 15)
MASS = 1 << 20
_STEPS = (np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]


def shingles(data: bytes, n: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of a text's different shingles; fewer words than one: the
    whole sequence is one; no word: none."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *gram_hashes(data, n)]))


def fingerprint(grams: np.ndarray) -> int:
    """SimHash: bits that over half of the set's hashes have."""
    seen = np.zeros(64, np.int64)
    for at in range(0, len(grams), 1 << 15):
        part = grams[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        seen += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(seen * 2 > len(grams), bitorder="little").view(np.uint64)[0])


def sketch(grams: np.ndarray) -> int:
    """A byte of each of eight min-hashes."""
    if not len(grams):
        return 0
    least = np.full(8, ~np.uint64(0))
    for at in range(0, len(grams), 1 << 12):
        least = np.minimum(least, mixed(grams[at : at + (1 << 12)][None, :] ^ _STEPS).min(axis=1))
    return int.from_bytes((mixed(least) & np.uint64(255)).astype(np.uint8).tobytes(), "little")


def size_class(n: int) -> int:
    return math.floor(math.log(n) / -math.log(LEAST)) if n else -2


def prints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key, code, sketch, size, class) of each row; key is
    the hash of the whole set. Null text counts as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.int64()), ("code", pa.int64()), ("sketch", pa.int64()), ("size", pa.int64()), ("class", pa.int32())])
    signed = lambda values: np.array(values, np.uint64).view(np.int64)

    def fold(batches):
        for b in batches:
            found = [(xxhash.xxh64_intdigest(g.tobytes()), fingerprint(g), sketch(g), len(g)) for at in range(0, b.num_rows, 500) for g in map(shingles, as_bytes(b.column(2).slice(at, 500)))]
            key, code, low, size = zip(*found) if found else ((), (), (), ())
            yield batch(schema, doc_id=b.column(0), text_hash=b.column(1), key=signed(key), code=signed(code), sketch=signed(low), size=np.array(size, np.int64), **{"class": np.array([size_class(n) for n in size], np.int32)})

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text")).mapInArrow(fold, "doc_id long, text_hash long, key long, code long, sketch long, size long, class int")


def _candidates(x: dict, y: dict, same: bool):
    """Yields arrays (place in x, place in y); each pair once if x is y."""
    radius = RADIUS if x["size"].max() >= FEW else RADIUS_FEW
    for q, at in GrayIndex(y["code"]).search_runs(x["code"], radius):
        a, b = x["size"][q], y["size"][at]
        near = (np.minimum(a, b) >= LEAST * np.maximum(a, b)) & ((q < at) if same else True)
        q, at = q[near], at[near]
        alike = (x["sketch"][q] ^ y["sketch"][at]).view(np.uint8).reshape(-1, 8) == 0
        near = alike.sum(axis=1) >= SAME
        yield q[near], at[near]


def _sides(table: pa.Table) -> list[dict]:
    """A meeting's blocks, in numpy; the sets stay as bytes."""
    out = []
    for n in sorted(range(len(table)), key=lambda i: table["block"][i].as_py()):
        rows = table["rows"].combine_chunks()[n].values
        of = lambda name: rows.field(name).to_numpy(zero_copy_only=False)
        side = {"key": of("key"), "code": of("code").view(np.uint64), "sketch": of("sketch").view(np.uint64), "size": of("size")}
        if "grams" in [f.name for f in rows.type]:
            side["grams"] = rows.field("grams")
        out.append(side)
    return out


def _having(table: pa.Table) -> pa.Table:
    """Keys that have a candidate in this meeting."""
    sides = _sides(table)
    x, y = sides[0], sides[-1]
    hit_x, hit_y = np.zeros(len(x["key"]), bool), np.zeros(len(y["key"]), bool)
    for q, at in _candidates(x, y, len(sides) == 1):
        hit_x[q], hit_y[at] = True, True
    return pa.table({"key": np.unique(np.concatenate([x["key"][hit_x], y["key"][hit_y]]))})


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard index of two sorted sets of at least ``LEAST``."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= LEAST * (len(a) + len(b) - both)


def _linked(table: pa.Table) -> pa.Table:
    """(a, b): verified links that connect all verified candidates of this
    meeting. Pairs that are connected already are not looked at."""
    sides = _sides(table)
    x, y = sides[0], sides[-1]
    same = len(sides) == 1
    shift = 0 if same else len(x["key"])
    label = np.arange(len(y["key"]) + shift)
    sets: dict[int, np.ndarray] = {}

    def grams(n: int) -> np.ndarray:
        if n not in sets:
            side, at = (x, n) if n < len(x["key"]) else (y, n - shift)
            sets[n] = np.frombuffer(side["grams"][int(at)].as_py(), np.uint64)
        return sets[n]

    keys = x["key"] if same else np.concatenate([x["key"], y["key"]])
    links = []
    for q, at in _candidates(x, y, same):
        order = np.argsort(q, kind="stable")
        q, at = q[order], at[order] + shift
        for one in np.split(np.arange(len(q)), np.flatnonzero(np.diff(q)) + 1):
            if not len(one):
                continue
            i, others = int(q[one[0]]), at[one]
            others = others[label[others] != label[i]]
            while len(others):
                j, others = int(others[0]), others[1:]
                if alike(grams(i), grams(j)):
                    links.append((keys[i], keys[j]))
                    label[label == label[j]] = label[i]
                    others = others[label[others] != label[i]]
    a, b = zip(*links) if links else ((), ())
    return pa.table({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _meetings(nodes: DataFrame, columns: list[str], room, meet, schema: str) -> DataFrame:
    """Deals each size class to blocks of about ``room(class)`` nodes and calls
    ``meet`` with each two blocks whose nodes may be partners."""
    # One row a class: at most about a hundred.
    sizes = {r["class"]: r["count"] for r in nodes.where("size > 3").groupBy("class").count().collect()}
    blocks = {c: -(-n // room(c)) for c, n in sizes.items()}
    first, total = {}, 0
    for c in sorted(blocks):
        first[c], total = total, total + blocks[c]
    if not total:
        return nodes.sparkSession.createDataFrame([], schema)
    low, many = (F.create_map(*[F.lit(x) for c in blocks for x in (c, of[c])]) for of in (first, blocks))
    block = low[F.col("class")] + F.pmod(F.xxhash64("key"), many[F.col("class")]).cast("int")
    dealt = nodes.where("size > 3").select("class", block.alias("block"), F.struct(*columns).alias("row"))
    packed = dealt.groupBy("class", "block").agg(F.collect_list("row").alias("rows"))
    # partners of a block: all of its class, and of the classes below and above
    start, end = F.coalesce(low[F.col("class") - 1], low[F.col("class")]), low[F.col("class")] + many[F.col("class")] + F.coalesce(many[F.col("class") + 1], F.lit(0))
    other = F.explode(F.sequence(start, end - 1)).alias("other")
    met = packed.select("block", "rows", other).select(F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "rows")
    pairs = sum(n * (n + 1) // 2 + n * blocks.get(c + 1, 0) for c, n in blocks.items())
    return met.repartition(min(pairs, 1024), "p", "q").groupBy("p", "q").applyInArrow(meet, schema)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, root, component_id) of each row of ``docs``: texts link
    where their sets have a Jaccard index of ``LEAST`` or more; component_id is
    the smallest doc_id reached, itself included, and root a number that each
    component has of its own. Null ids take part in links but are never the
    smallest; a component of null ids alone has a null id. Rows of one set, or of
    one component, that are very many are dealt to several tasks. An empty table
    gives an empty result."""
    printed = written(prints(docs))
    first = lambda c: F.min(c).alias(c)  # noqa: E731 - all rows of a key agree in it
    nodes = written(printed.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), first("text_hash"), first("code"), first("sketch"), first("size"), first("class")))
    room = min(max(BLOCK[0], nodes.count() // 64), BLOCK[1])
    having = written(_meetings(nodes, ["key", "code", "sketch", "size"], lambda c: room, _having, "key long").distinct())
    texts = nodes.join(having, "key", "left_semi").select("key", "code", "sketch", "size", "class", F.col("text_hash").alias("_hash"))
    own = docs.select(F.xxhash64("text").alias("_text"), "text").join(texts, F.col("_text") == F.col("_hash")).dropDuplicates(["key"]).drop("_text", "_hash")
    fields = "key long, code long, sketch long, size long, class int, grams binary"

    def gather(batches):
        for b in batches:
            grams = pa.array([shingles(t).tobytes() for t in as_bytes(b.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(n) for n in ("key", "code", "sketch", "size", "class")] + [grams], names=["key", "code", "sketch", "size", "class", "grams"])

    sets = written(own.select("key", "code", "sketch", "size", "class", "text").mapInArrow(gather, fields))
    mass = lambda c: max(16, min(room, int(MASS / LEAST ** -(c + 1))))
    roots = connected(_meetings(sets, ["key", "code", "sketch", "size", "grams"], mass, _linked, "a long, b long"))
    rooted = written(nodes.select("key", "least").join(roots, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root")))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    labels = written(join_hot(rooted.drop("least"), groups.drop("n"), "root", hot_keys(groups, ["root"])))
    out = written(join_hot(printed, labels, "key", hot_keys(nodes, ["key"])).select("doc_id", "text_hash", "root", "component_id"))
    drop(printed, nodes, having, sets, rooted, labels)
    return out
