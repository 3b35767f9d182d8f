"""Mixing sources to target weights with soft membership.

A classifier fitted on a labelled table gives every document a posterior over domains. The mix is a nonnegative rate for each
document such that the expected tokens of each domain (rate times tokens times posterior, summed over documents) meet
their targets, by projected-gradient least squares.

With S the domain totals, T the targets and N the totals at rate 1, the objective is the sum of (S - T)**2 / N. In the metric of
the documents' token counts its gradient at a document is the posterior times (S - T) / N, and the largest curvature is at most
1, so any step size below 2 is safe. A document's rate then depends on its posterior and on the residuals of past steps only,
which are a few numbers each: every step is one aggregation of a compact table over an expression that replays the residuals. Nothing is
joined, updated in place or collected but the domain totals.
"""

from __future__ import annotations

import logging
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordIds, hash_sample, spread, table

log = logging.getLogger(__name__)

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Domains of the labels table, and their shares of all tokens of the mix.
TARGETS = {"good": 0.86, "poor": 0.14, "toxic": 0.0}
BUDGET = 1.25
DENSE = 6
#: Step size of the projected gradient.
STEP = 1.5


def _features(raw: bytes, ids: WordIds) -> tuple[np.ndarray, list[float]]:
    """All word hashes in order, and shares that describe the form of a text."""
    words = WORD.findall(raw.lower())
    n, data = max(1, len(raw)), np.frombuffer(raw, np.uint8)
    letters = int(((data | 32) >= 97).sum()) - int(((data | 32) > 122).sum()) + int((data >= 128).sum())
    lines = raw.split(b"\n")
    dense = [letters / n, int(((data >= 48) & (data <= 57)).sum()) / n, int((data == 32).sum()) / n, min(1.0, len(lines) * 40 / n), len(set(lines)) / len(lines), min(1.0, np.log1p(len(words)) / 10)]
    return ids.array(words), dense


class Classifier:
    """Softmax regression on the presence of chosen words and on the dense shares."""

    def __init__(self, domains: list[str], words: np.ndarray, weights: np.ndarray):
        self.domains, self.words, self.weights = domains, words, weights

    def row(self, hashes: np.ndarray, dense: list[float]) -> np.ndarray:
        x = np.zeros(len(self.words) + DENSE + 1)
        if len(self.words) and len(hashes):
            k = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            x[k[self.words[k] == hashes]] = 1
        x[len(self.words) : -1] = dense
        x[-1] = 1
        return x

    def posterior(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.weights
        p = np.exp(s - s.max(-1, keepdims=True))
        return p / p.sum(-1, keepdims=True)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", domain: str = "domain", sample: int = 8_000, n_words: int = 256, steps: int = 300) -> Classifier:
    """labels: doc_id and domain. Fits on at most `sample` labelled rows, the first by hash (the only bound): so few are
    sent to the executors, and documents stay where they are. Rows with a null id, domain or text teach nothing."""
    few = labels.filter(F.col(domain).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(domain).alias("_domain"))
    few = hash_sample(few, ["_id", "_domain"], sample)
    picked = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("raw")).filter("raw is not null").join(F.broadcast(few), "_id").select("_domain", "raw")
    scratch = Scratch(docs.sparkSession, "mixing")
    picked = scratch.write(picked)

    def words(batches):
        import pyarrow as pa

        ids = WordIds()
        for batch in batches:
            for name, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h = np.unique(_features(cell.as_py(), ids)[0]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(h), pa.string()), pa.array(h)], names=["domain", "h"])

    sizes = {r["_domain"]: r["n"] for r in picked.groupBy("_domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(sizes)
    if not domains:
        return Classifier([], np.zeros(0, np.uint64), np.zeros((DENSE + 1, 0)))
    total = sum(sizes.values())
    have = picked.mapInArrow(words, "domain string, h long").groupBy("h").agg(*[F.sum((F.col("domain") == d).cast("long")).alias(f"c{k}") for k, d in enumerate(domains)])
    every = sum((F.col(f"c{k}") for k in range(1, len(domains))), F.col("c0"))
    tells = F.greatest(*[F.abs(F.col(f"c{k}") - every * (sizes[d] / total)) / F.sqrt(every * (sizes[d] / total) + 1) for k, d in enumerate(domains)]) if len(domains) > 1 else F.lit(0.0)
    chosen = np.sort(np.array([r["h"] for r in have.withColumn("z", tells).orderBy(F.desc("z"), "h").limit(n_words).collect()], np.int64).view(np.uint64))
    model = Classifier(domains, chosen, np.zeros((len(chosen) + DENSE + 1, len(domains))))

    def rows(batches):
        import pyarrow as pa

        ids = WordIds()
        for batch in batches:
            x = [model.row(*_features(c.as_py(), ids)).astype(np.float32).tobytes() for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["domain", "x"])

    got = sorted((r["domain"], bytes(r["x"])) for r in picked.mapInArrow(rows, "domain string, x binary").collect())
    x, y = np.array([np.frombuffer(v, np.float32) for _, v in got]), np.eye(len(domains))[[domains.index(d) for d, _ in got]]
    moment, square = np.zeros_like(model.weights), np.zeros_like(model.weights)
    for step in range(1, steps + 1):
        g = x.T @ (y - model.posterior(x)) / len(x) - 1e-4 * model.weights
        moment, square = 0.9 * moment + 0.1 * g, 0.99 * square + 0.01 * g * g
        model.weights = model.weights + 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return model


def posteriors(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """docs with n_tokens (words; null and empty texts have none) and posterior (array, in the order of model.domains)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        ids, m = WordIds(), sent.value
        for batch in batches:
            n, p = [], []
            for cell in batch.column(at):
                raw = cell.as_py() or b""
                hashes, dense = _features(raw.encode() if isinstance(raw, str) else raw, ids)
                n.append(len(hashes))
                p.append(m.posterior(m.row(hashes, dense)).tolist() if m.domains else [])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64()))], names=[*batch.schema.names, "n_tokens", "posterior"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields], "n_tokens long, posterior array<double>"])
    return docs.mapInArrow(run, schema)


def _likely():
    """The place of the likeliest domain, counted from 1; null without domains. Ties go to the first."""
    return F.array_position("posterior", F.array_max("posterior"))


def _rate(history: list[list[float]], barred: list[int]):
    """The rate after some steps: from 1, each step takes the posterior's share of the residual off, never below 0. barred:
    places of domains that are to have nothing; documents that are likeliest of such a domain have rate 0 throughout."""
    r = F.lit(1.0)
    if history:
        steps = F.array(*[F.array(*[F.lit(float(v)) for v in h]) for h in history])
        r = F.aggregate(steps, r, lambda acc, h: F.greatest(F.lit(0.0), acc - F.aggregate(F.zip_with("posterior", h, lambda p, e: p * e), F.lit(0.0), lambda s, v: s + v)))
    return F.when(_likely().isin(barred), F.lit(0.0)).otherwise(r) if barred else r


def barred(domains: list[str], targets: dict[str, float]) -> list[int]:
    return [k + 1 for k, d in enumerate(domains) if not targets.get(d)]


def solve(weights: DataFrame, domains: list[str], targets: dict[str, float], budget: float = BUDGET, steps: int = 25, close: float = 1e-4) -> list[list[float]]:
    """weights: n_tokens and posterior. targets: share of each domain; a domain without one gets none. Returns the
    residuals that _rate replays; stops when all totals are within `close` of the budget, or when a step changes none of them
    by a tenth of that: then the least-squares solution misses targets (for instance because every document is a little toxic),
    and what is missing is logged as a warning."""
    history: list[list[float]] = []
    none, before = barred(domains, targets), None
    if not domains:
        return history
    total = norm = goal = None
    for _ in range(steps + 2):
        rate = _rate(history, none if total is not None else [])  # the totals at rate 1 are those of all documents
        sums = weights.select("n_tokens", "posterior", rate.alias("r")).agg(*[F.sum(F.col("r") * F.col("n_tokens") * F.col("posterior")[k]) for k in range(len(domains))]).first()
        now = np.array([v or 0.0 for v in sums])
        if total is None:
            total, norm = now.sum(), now
            goal = np.array([targets.get(d, 0.0) for d in domains]) * budget * total
            if none:
                continue
        if not total or np.abs(now - goal).max() <= close * budget * total:
            break
        if len(history) == steps or before is not None and np.abs(now - before).max() <= 0.1 * close * budget * total:
            log.warning("shares of the mix that miss their targets: %s", {d: round(float(x), 6) for d, x in zip(domains, (now - goal) / (budget * total), strict=True)})
            break
        before = now
        history.append((STEP * np.where(norm > 0, (now - goal) / np.maximum(norm, 1e-12), 0.0)).tolist())
    return history


def with_rates(docs: DataFrame, history: list[list[float]], domains: list[str], targets: dict[str, float], key: str) -> DataFrame:
    """Adds rate, domain (the likeliest, null without a model) and copies: rate rounded up or down by a hash of key, so
    that it is right in expectation and the same each time. Rows with the same key are rounded alike."""
    names = F.array(*[F.lit(d) for d in domains]) if domains else None
    likely = F.get(names, _likely().cast("int") - 1) if domains else F.lit(None).cast("string")
    chance = F.pmod(F.xxhash64(F.lit(11), key), F.lit(1_000_000)) / 1_000_000.0
    return docs.withColumn("rate", _rate(history, barred(domains, targets))).withColumn("domain", likely).withColumn("copies", F.floor(F.col("rate") + chance).cast("long"))


def domain_labels(labels: DataFrame) -> DataFrame:
    """Domains of the labels table: toxic, else good or poor by quality; rows without what decides have none."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("domain"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with n_tokens, posterior, rate, domain and copies; columns of docs with these names are replaced. budget is the
    mix's size in multiples of all tokens. Without labelled documents there are no domains, and every rate is 1. Documents that
    are likeliest of a domain whose target is 0 have rate 0. Null and empty texts have no tokens, and a posterior from their
    form alone. docs are classified once and written to the shared folder; each step of the solution reads two columns."""
    docs = docs.drop("n_tokens", "posterior", "rate", "domain", "copies")
    targets = targets or TARGETS
    model = fit(docs, labels, doc_id, text)
    marked = Scratch(docs.sparkSession, "mix").write(posteriors(docs, model, text))
    return with_rates(marked, solve(marked, model.domains, targets, budget), model.domains, targets, doc_id)


def op9_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Every row of documents; domains from the labels table, targets and budget as above."""
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "text")
    model = fit(docs, domain_labels(table(spark, sf_dir, "labels")))
    weights = Scratch(spark, "mix").write(posteriors(docs, model).select("doc_id", "n_tokens", "posterior"))
    out = with_rates(weights, solve(weights, model.domains, TARGETS), model.domains, TARGETS, "doc_id")
    return out.select("doc_id", "n_tokens", "domain", F.array_max("posterior").alias("p_domain"), "rate", "copies")
