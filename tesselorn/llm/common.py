"""What several operators share: shared-folder tables, tokens, packed arrays."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselorn.sources.shared import remove, remove_at_exit, shared_dir


def written(df: DataFrame, codec: str = "zstd", by: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, in folders by the values of ``by``:
    cuts the lineage, survives lost executors, is computed once. Removed when the
    process ends, or by ``drop``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tesselorn-{uuid.uuid4().hex}"
    write = df.write.option("compression", codec)
    (write.partitionBy(by) if by else write).parquet(path)
    remove_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tesselorn_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Removes tables of ``written`` that nothing reads any more."""
    for t in tables:
        remove(t.sparkSession, t._tesselorn_path)


#: Rows of a key from which on a join deals them to several tasks.
HOT_ROWS = 1_000_000
#: Tasks that a hot key's rows are dealt to.
SALTS = 64


def join_hot(many: DataFrame, one: DataFrame, keys: str | list[str], hot: list, how: str = "inner") -> DataFrame:
    """``many`` joined by ``keys`` with ``one``, which has a row for each key. Rows of
    the keys in ``hot`` (rows of ``keys``) are dealt to ``SALTS`` tasks each, whose
    row of ``one`` is repeated; so no task gets a hot key whole. A row's task
    follows from its columns, so that a repeated task deals it out alike. There
    are at most as many hot keys as rows over ``HOT_ROWS``."""
    keys = [keys] if isinstance(keys, str) else keys
    if not hot:
        return many.join(one, keys, how)
    kinds = ", ".join(f"`{k}` {one.schema[k].dataType.simpleString()}" for k in keys)
    marked = F.broadcast(many.sparkSession.createDataFrame([tuple(h) for h in hot], kinds).withColumn("_hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]), F.lit(SALTS)).cast("int")
    left = many.join(marked, keys, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0))).drop("_hot")
    copies = F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    right = one.join(marked, keys, "left").withColumn("_salt", copies).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def hot_keys(counted: DataFrame, keys: list[str], most: int | None = None) -> list:
    """Rows of ``keys`` whose column n is over ``most`` (``HOT_ROWS``)."""
    return counted.where(F.col("n") > (HOT_ROWS if most is None else most)).select(*keys).collect()


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as make them new to ``docs``."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def remainder(doc_id: Column, of: int = 5) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


#: Stands for a null id where ids are packed in arrays.
NO_ID = -(1 << 63)


def crc(doc_id: int) -> int:
    return zlib.crc32(b"" if doc_id == NO_ID else str(int(doc_id)).encode())


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null gives empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_pieces(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``size`` bytes of it: a very long
    text is never held as one list."""
    at = 0
    while at < len(data):
        end = len(data)
        if at + size < end and (found := _SPACE.search(data, at + size)):
            end = found.start()
        yield data[at:end].split()
        at = end


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z lower-cased, split at ``[\\x20\\x09-\\x0D]+``,
    in order; and how many each text has. Null gives none."""
    # a copy: the splitting kernel misreads arrays that are slices
    texts = pc.fill_null(column.cast(pa.large_string()), "").take(pa.array(np.arange(len(column))))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)), np.diff(upto[offsets - offsets[0]])


def hashed(words: pa.Array) -> np.ndarray:
    """XXH64 of each word, hashing each distinct word once."""
    import xxhash

    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    one = xxhash.xxh64_intdigest
    keys = [one(x) for x in coded.dictionary.cast(pa.large_binary()).to_pylist()]
    return np.array(keys, np.uint64)[coded.indices.to_numpy()]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(a: np.ndarray) -> bytes:
    """An integer array by byte planes, compressed: small numbers cost little."""
    a = np.ascontiguousarray(a, np.uint64)
    planes = a.view(np.uint8).reshape(-1, 8).T
    top = 8
    while top > 1 and not planes[top - 1].any():
        top -= 1
    body = np.ascontiguousarray(planes[:top]).tobytes()
    return len(a).to_bytes(6, "little") + bytes([top]) + pa.compress(body, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n, top = int.from_bytes(data[:6], "little"), data[6]
    out = np.zeros((n, 8), np.uint8)
    if n:
        body = pa.decompress(data[7:], n * top, codec="zstd", asbytes=True)
        out[:, :top] = np.frombuffer(body, np.uint8).reshape(top, n).T
    return out.reshape(-1).view(np.uint64)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def joined(parts: list[bytes]) -> bytes:
    """Several byte strings in one."""
    return b"".join(len(p).to_bytes(6, "little") + p for p in parts)


def parted(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 6], "little")
        out.append(data[at + 6 : at + 6 + n])
        at += 6 + n
    return out


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def components(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable over the links a-b, for each of n indices."""
    label = np.arange(n) if label is None else label
    while True:
        x, y = label[a], label[b]
        far = x != y
        if not far.any():
            return label
        a, b, x, y = a[far], b[far], x[far], y[far]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
