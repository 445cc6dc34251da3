"""Quality classifier: a factorisation machine.

Inputs: distinct hashed words, structure statistics and the recorded length.
Every pair of inputs has the inner product of their low-rank vectors as weight;
the sum over all pairs is half of (squared sum less sum of squares), so a text
is scored in time linear in its words.

It is fitted on the driver over a bounded sample of labelled rows
(``max_labelled``, those of least id hash); scoring is one pass over the texts.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselorn.llm.common import as_bytes, batch, remainder, word_pieces
from tesselorn.llm.features import STRUCTURE, WORD_BITS, structure, words

RANK = 4
MAX_LABELLED = 6000
EPOCHS = 8
THRESHOLD = 0.3


@dataclass
class Machine:
    bias: float
    linear: np.ndarray  # words, then structure
    vectors: np.ndarray

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.vectors[at] * x[:, None]
        s = v.sum(0)
        return float(self.bias + self.linear[at] @ x + 0.5 * (s @ s - (v * v).sum()))

    def score(self, text: bytes, n_chars: int | None) -> float:
        """Between 0 and 1."""
        at, x = inputs(text, n_chars)
        return float(1 / (1 + np.exp(-np.clip(self.raw(at, x), -40, 40))))


def inputs(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    seen = Counter()
    for some in word_pieces(text):
        seen.update(some)
    own = words(seen)
    at = np.concatenate([own, np.arange(len(STRUCTURE), dtype=np.int32) + (1 << WORD_BITS)])
    x = np.concatenate([np.full(len(own), 1 / np.sqrt(max(len(own), 1)), np.float32), structure(text, seen, n_chars)])
    return at, x


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], rank: int = RANK, epochs: int = EPOCHS, rate: float = 0.1, seed: int = 7) -> Machine:
    """Stochastic gradients of the logistic loss with per-input step sizes. With
    one label only, that label's share is all that is learnt."""
    rng = np.random.default_rng(seed)
    size = (1 << WORD_BITS) + len(STRUCTURE)
    share = (sum(y for *_, y in rows) + 0.5) / (len(rows) + 1)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size, np.float32), rng.normal(0, 0.02, (size, rank)).astype(np.float32))
    seen_w, seen_v, seen_b = np.full(size, 1e-2, np.float32), np.full((size, rank), 1e-2, np.float32), 1.0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            v = m.vectors[at]
            s = x @ v
            sq = (v * x[:, None]) ** 2
            raw = m.bias + m.linear[at] @ x + 0.5 * (s @ s - sq.sum())
            g = 1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y
            gw = g * x + 1e-5 * m.linear[at]
            gv = g * (x[:, None] * (s - v * x[:, None])) + 1e-4 * v
            seen_w[at] += gw * gw
            seen_v[at] += gv * gv
            seen_b += g * g
            m.linear[at] -= rate * gw / np.sqrt(seen_w[at])
            m.vectors[at] -= rate * gv / np.sqrt(seen_v[at])
            m.bias -= float(rate * g / np.sqrt(seen_b))
    return m


def sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, most: int, extra: list[str]) -> list:
    """(_id, _label, text, extra...) of at most ``most`` labelled ids of documents:
    those of least hash. Ids and labels are nowhere null; an id's label is its
    least one, and of its several texts the one of least hash counts."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("_label"))
    few = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    row = F.struct(F.xxhash64(f"`{text_col}`").alias("hash"), F.col(f"`{text_col}`").alias("text"), *extra)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), row.alias("_row"))
    got = own.join(F.broadcast(few.select(F.col("doc_id").cast("long").alias("_id"), "_label")), "_id").groupBy("_id", "_label").agg(F.min("_row").alias("_row"))
    return got.select("_id", "_label", "_row.text", *[f"_row.{c}" for c in extra])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> Machine:
    """Fitted on labels (doc_id, ``label`` 0 or 1); no row or one label: the share."""
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), n_chars.alias("_n_chars"))
    got = sample(own, labels, label, "doc_id", "text", max_labelled, ["_n_chars"])
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("at", pa.binary()), ("x", pa.binary())])

    def fold(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                rows = [inputs(t, n) for t, n in zip(as_bytes(part.column(2)), part.column(3).to_pylist())]
                yield batch(schema, id=part.column(0), label=part.column(1).cast(pa.int32()), at=[a.tobytes() for a, _ in rows], x=[x.tobytes() for _, x in rows])

    found = got.mapInArrow(fold, "id long, label int, at binary, x binary").toArrow().sort_by("id")
    columns = [found[c].to_pylist() for c in ("at", "x", "label")]
    return fit([(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32), y) for a, x, y in zip(*columns)])


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for each row; null and empty texts are scored as empty."""
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # a few MB, by WORD_BITS and rank

    def fold(batches):
        m = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                yield batch(schema, doc_id=part.column(0), score=[m.score(t, n) for t, n in zip(as_bytes(part.column(1)), part.column(2).to_pylist())])

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"), n_chars).mapInArrow(fold, "doc_id long, score double")


def kept(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, unchanged;
    no exchange of rows. Null texts are scored as empty."""
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    own = docs.select(F.col(f"`{text_col}`").alias("_text"), n_chars.alias("_n_chars"), *[F.col(f"`{c}`") for c in docs.columns])

    names = docs.columns

    def fold(batches):
        m = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                score = [m.score(t, n) for t, n in zip(as_bytes(part.column(0)), part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(part.columns[2:], names=names).filter(pa.array([s >= threshold for s in score], pa.bool_()))

    return own.mapInArrow(fold, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Labels are learnt only from ids whose crc32 (as text) mod 5 is not 0; the
    others are held out. A null id counts as empty text: held out. predicted is
    1 where the score is at least 0.3. No label at all: every score is 0.5.
    Repeated rows are scored each; an empty table gives an empty result.
    """
    machine = train(docs, labels.where(remainder(F.col("doc_id")) != 0), label, max_labelled=max_labelled)
    return score(docs, machine).select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
