"""Mixing sources to target weights by soft membership.

A multinomial classifier, fitted on a labelled table, gives each document its
domain posteriors p. Nonnegative document rates r (expected copies) are then
fitted by projected-gradient least squares: with the shares t of the corpus's
tokens they minimise

    1/2 |sum_d t_d r_d p_d - target|^2 + ridge/2 sum_d t_d (r_d - 1)^2,  r >= 0

The ridge makes the answer one and only, also where no rates meet the target:
without it a target of 0 for a domain would leave a handful of documents only.

A rate is the projection onto r >= 0 of a gradient step from 1, which is p times
one number for each domain: r = max(0, 1 - p.z). Each pass over the documents
sums the gradient and the curvature of those not held at 0; the step is scaled by
that small matrix, and shortened until the dual objective grows. Passes go on
until the duality gap, the most by which the objective can exceed its least
value, is closed. No state is kept for a document between passes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselorn.llm.common import as_bytes, batch, word_pieces, written
from tesselorn.llm.features import STRUCTURE, WORD_BITS
from tesselorn.llm.quality import inputs

MAX_LABELLED = 6000
EPOCHS, RATE = 16, 0.5
RIDGE = 1e-4
#: Passes go on until the duality gap is this small; ``PASSES`` without is an error.
GAP, PASSES = 1e-9, 200


@dataclass
class Domains:
    names: list[str]
    bias: np.ndarray
    weights: np.ndarray  # inputs by domain

    def posteriors(self, text: bytes, n_chars: int | None) -> np.ndarray:
        at, x = inputs(text, n_chars)
        z = self.bias + x @ self.weights[at]
        e = np.exp(z - z.max())
        return e / e.sum()


def fit_domains(rows: list[tuple[np.ndarray, np.ndarray, str]], rate: float = RATE, epochs: int = EPOCHS, seed: int = 11) -> Domains:
    """Stochastic gradients of the cross entropy, with per-input step sizes."""
    names = sorted({d for *_, d in rows})
    code = {d: i for i, d in enumerate(names)}
    rng = np.random.default_rng(seed)
    prior = np.array([sum(d == name for *_, d in rows) for name in names], float)
    m = Domains(names, np.log(prior / prior.sum()).astype(np.float32) if names else np.zeros(0), np.zeros(((1 << WORD_BITS) + len(STRUCTURE), len(names)), np.float32))
    seen = np.full(m.weights.shape, 1e-2, np.float32)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x, d = rows[i]
            z = m.bias + x @ m.weights[at]
            p = np.exp(z - z.max())
            p /= p.sum()
            p[code[d]] -= 1
            g = x[:, None] * p + 1e-5 * m.weights[at]
            seen[at] += g * g
            m.weights[at] -= rate * g / np.sqrt(seen[at])
    return m


def train(docs: DataFrame, labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> Domains:
    """A classifier of ``labelled`` (doc_id, domain): on at most ``max_labelled``
    ids, those of least hash. Rows with a null are left out; of an id's several
    texts the one of least hash counts."""
    few = labelled.dropna(subset=["doc_id", "domain"]).groupBy("doc_id").agg(F.min("domain").alias("_domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(F.xxhash64("text").alias("hash"), "text", n_chars.alias("n_chars")).alias("_row"))
    got = own.join(F.broadcast(few), "doc_id").groupBy("doc_id", "_domain").agg(F.min("_row").alias("_row")).select("doc_id", "_domain", "_row.text", "_row.n_chars")
    schema = pa.schema([("id", pa.int64()), ("domain", pa.string()), ("at", pa.binary()), ("x", pa.binary())])

    def fold(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                rows = [inputs(t, n) for t, n in zip(as_bytes(part.column(2)), part.column(3).to_pylist())]
                yield batch(schema, id=part.column(0), domain=part.column(1), at=[a.tobytes() for a, _ in rows], x=[x.tobytes() for _, x in rows])

    found = got.mapInArrow(fold, "id long, domain string, at binary, x binary").toArrow().sort_by("id")
    columns = [found[c].to_pylist() for c in ("at", "x", "domain")]
    return fit_domains([(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32), d) for a, x, d in zip(*columns)])


def members(docs: DataFrame, domains: Domains) -> DataFrame:
    """(doc_id, text_hash, n_tokens, posteriors): white-space tokens of the whole
    text and its posteriors, in the order of ``domains.names``."""
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_tokens", pa.int64()), ("posteriors", pa.list_(pa.float64()))])
    shared = docs.sparkSession.sparkContext.broadcast(domains)  # inputs by domains: a few MB

    def fold(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = as_bytes(part.column(2))
                yield batch(schema, doc_id=part.column(0), text_hash=part.column(1), n_tokens=[sum(map(len, word_pieces(t))) for t in texts], posteriors=[shared.value.posteriors(t, n).tolist() for t, n in zip(texts, part.column(3).to_pylist())])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text", n_chars).mapInArrow(fold, "doc_id long, text_hash long, n_tokens long, posteriors array<double>")


def rates(p: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Rates of documents with posteriors ``p``, for a step of ``z``."""
    return np.maximum(0, 1 - p @ z)


def _sums(table: DataFrame, z: np.ndarray, tokens: float = 1.0) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One pass: the domains' tokens at these rates, the curvature of documents
    not held at 0, and the sums of (rate - 1)^2 and of the dual's terms, all as
    shares of ``tokens``."""
    k = len(z)

    def fold(batches):
        for b in batches:
            if len(b):
                p, t = np.stack(b["posteriors"].to_numpy()), b["n_tokens"].to_numpy(float)
                step = p @ z
                r, free = np.maximum(0, 1 - step), step < 1
                dual = np.where(free, step - step * step / 2, 0.5)
                sums = [*(p.T @ (t * r)), *((p * (t * free)[:, None]).T @ p).ravel(), t @ (r - 1) ** 2, t @ dual]
                yield pd.DataFrame({"sums": [[float(x) for x in sums]]})

    n = k + k * k + 2
    row = table.select("n_tokens", "posteriors").mapInPandas(fold, "sums array<double>").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(n)]).first()
    found = np.array([row[f"s{i}"] or 0.0 for i in range(n)]) / tokens
    return found[:k], found[k:-2].reshape(k, k), found[-2], found[-1]


def fit_rates(table: DataFrame, shares: np.ndarray, budget: float = 1.0, ridge: float = RIDGE) -> np.ndarray:
    """The step z of the rates that solve the problem above. ``budget``: tokens
    wanted, as a multiple of the corpus's."""
    k, want = len(shares), shares * budget
    tokens = _sums(table, np.zeros(k))[0].sum()
    if not tokens:
        return np.zeros(k)

    def at(v: np.ndarray):
        now, curvature, apart, dual = _sums(table, v / ridge, tokens)
        primal = 0.5 * ((now - want) ** 2).sum() + 0.5 * ridge * apart
        return now - want, curvature, primal, ridge * dual - 0.5 * v @ v - v @ want

    v = np.zeros(k)
    residual, curvature, primal, dual = at(v)
    passes = 1
    while primal - dual > GAP:
        slope = residual - v
        step = np.linalg.solve(np.eye(k) + curvature / ridge, slope)
        size = 1.0
        while True:
            if passes == PASSES:
                raise RuntimeError(f"the duality gap is {primal - dual} after {PASSES} passes")
            passes += 1
            found = at(v + size * step)
            if found[3] >= dual + 1e-4 * size * (slope @ step):
                break
            size /= 2
        v = v + size * step
        residual, curvature, primal, dual = found
    return v / ridge


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float = 1.0, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text_hash, n_tokens, <p_domain>..., rate, copies) for each row.

    ``targets``: wanted share of expected tokens for each domain, scaled to sum
    to 1 over the domains that labelled documents have; a domain of the labels
    without one gets 0. Domains whose names differ in case alone are an error. copies is the rate rounded up or down by a hash of the id, so that its
    mean is the rate. Null and empty texts have no token, keep rate by their
    posteriors and change no sum. Repeated rows are fitted each. An empty table
    gives an empty result; without any labelled document of a target's domain an error is raised.
    """
    domains = train(docs, labelled, max_labelled)
    if len({d.lower() for d in domains.names}) < len(domains.names):
        raise ValueError(f"domains that differ in case alone: {domains.names}")
    if sum(targets.get(d, 0.0) for d in domains.names) <= 0:
        if docs.isEmpty():
            shape = ["doc_id long", "text_hash long", "n_tokens long", *[f"p_{d} double" for d in sorted(targets)], "rate double", "copies int"]
            return docs.sparkSession.createDataFrame([], ", ".join(shape))
        raise ValueError(f"targets {sorted(targets)} for the labelled domains {domains.names}")
    shares = np.array([targets.get(d, 0.0) for d in domains.names])
    table = written(members(docs, domains))
    z = fit_rates(table, shares / shares.sum(), budget=budget)

    def fold(batches):
        for b in batches:
            p = np.stack(b["posteriors"].to_numpy()) if len(b) else np.zeros((0, len(shares)))
            yield b.assign(rate=rates(p, z))

    out = table.mapInPandas(fold, "doc_id long, text_hash long, n_tokens long, posteriors array<double>, rate double")
    part = F.pmod(F.xxhash64(F.lit("copies"), "doc_id", "text_hash"), F.lit(1 << 20)) / (1 << 20)
    return out.select("doc_id", "text_hash", "n_tokens", *[F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(domains.names)], "rate", (F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("copies"))
