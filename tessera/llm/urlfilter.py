"""URL filters: rules first, then gradient-boosted trees over lexical features of the URL.

All features are built-in expressions and the fitted trees become nested CASE expressions, so judging a table of URLs
is one projection inside the JVM: no shuffle, no Python. Fitting aggregates suffix statistics over all labelled URLs
into a fixed number of hash buckets and grows the trees on a sample of at most `sample` labelled rows (the only bound;
chosen by hash order, so the same rows give the same model).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, hash_sample, parts, table, whole

FEATURES = ["__f_length", "__f_host_length", "__f_path_length", "__f_depth", "__f_labels", "__f_digit_ratio", "__f_host_digit_ratio", "__f_entropy", "__f_params", "__f_hyphens", "__f_other_ratio", "__f_secure", "__f_fragment", "__f_suffix1", "__f_suffix2", "__f_first"]
STATS, FOLDS = ("suffix1", "suffix2", "first"), 5
#: Allow and block rules as (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def _parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where url is null or has no "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def with_parts(df: DataFrame, url: str) -> DataFrame:
    host, path = _parts(F.col(url))
    return df.withColumn("host", host).withColumn("path", path)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct (verdict, rule); null where none fits. A rule fits its host and every
    subdomain if the path starts with the rule's path. rules is a driver-side list that becomes one CASE."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        got = F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))
        out = F.when(fits, got) if out is None else out.when(fits, got)
    return out if out is not None else F.lit(None).cast("struct<verdict:string,rule:string>")


def _ratio(text: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(text, kept, "")) / F.greatest(F.length(text), F.lit(1))


def _suffix_bucket(host: Column, labels: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -labels)), F.lit(buckets)).cast("int")


def _first(path: Column, buckets: int) -> Column:
    """Bucket of the path's first folder."""
    return F.pmod(F.xxhash64(F.lit("path"), F.regexp_extract(path, r"^/([^/]*)/", 1)), F.lit(buckets)).cast("int")


def features(url: Column, host: Column, path: Column, stats: dict[str, list[float]], fold: Column | None = None) -> dict[str, Column]:
    """The columns FEATURES. stats: three lists of smoothed block rates, by bucket; with fold, such lists one after another
    for each fold."""
    u = F.coalesce(url, F.lit(""))
    n = F.length(u)
    share = lambda c: (n - F.length(F.replace(u, c, F.lit("")))) / n
    entropy = F.aggregate(F.filter(F.array_distinct(F.split(u, "")), lambda c: c != ""), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    query = F.when(F.instr(u, "?") > 0, F.substring_index(F.regexp_extract(u, r"\?(.*)$", 1), "#", 1))
    k = len(stats["suffix1"]) // (1 if fold is None else FOLDS)
    look = lambda name, bucket: F.element_at(F.array(*[F.lit(x) for x in stats[name]]), bucket + 1 + (0 if fold is None else fold * k))
    return {
        "__f_length": n.cast("double"),
        "__f_host_length": F.length(host).cast("double"),
        "__f_path_length": F.length(path).cast("double"),
        "__f_depth": (F.size(F.split(path, "/")) - 1).cast("double"),
        "__f_labels": F.size(F.split(host, r"\.")).cast("double"),
        "__f_digit_ratio": _ratio(u, "[^0-9]"),
        "__f_host_digit_ratio": _ratio(host, "[^0-9]"),
        "__f_entropy": entropy,
        "__f_params": F.coalesce(F.size(F.split(query, "&")).cast("double"), F.lit(0.0)),
        "__f_hyphens": (F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).cast("double"),
        "__f_other_ratio": _ratio(u, "[A-Za-z0-9]"),
        "__f_secure": u.startswith("https:").cast("double"),
        "__f_fragment": (F.instr(u, "#") > 0).cast("double"),
        "__f_suffix1": look("suffix1", _suffix_bucket(host, 1, k)),
        "__f_suffix2": look("suffix2", _suffix_bucket(host, 2, k)),
        "__f_first": look("first", _first(path, k)),
    }


@dataclass
class UrlModel:
    """stats: smoothed block rates by bucket. trees: nested (feature, threshold, left, right) or a leaf's weight."""

    stats: dict
    base: float
    trees: list

    def margin(self, given: dict[str, Column]) -> Column:
        """The log-odds of block, over the features."""

        def walk(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            k, at, left, right = node
            return F.when(given[FEATURES[k]] <= F.lit(float(at)), walk(left)).otherwise(walk(right))

        out = F.lit(self.base)
        for tree in self.trees:
            out = out + walk(tree)
        return out


def _bin(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for k in range(x.shape[1])]


def boost(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, bins: int = 32, ridge: float = 1.0, least: int = 5) -> tuple[float, list]:
    """Second-order boosting on the logistic loss with histogram splits; the same rows give the same trees."""
    if not len(y) or y.min() == y.max():
        odds = (y.sum() + 0.5) / (len(y) - y.sum() + 0.5)
        return (math.log(odds) if len(y) else 0.0), []
    edges = _bin(x, bins)
    coded = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    f, out = np.full(len(y), base), []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, left: int):
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-9, None)
        if left:
            for k, e in enumerate(edges):
                if not len(e):
                    continue
                m = len(e) + 1
                cg = np.cumsum(np.bincount(coded[rows, k], g[rows], m))[:-1]
                ch = np.cumsum(np.bincount(coded[rows, k], h[rows], m))[:-1]
                cn = np.cumsum(np.bincount(coded[rows, k], minlength=m))[:-1]
                gain = cg**2 / (ch + ridge) + (gs - cg) ** 2 / (hs - ch + ridge) - gs**2 / (hs + ridge)
                gain[(cn < least) | (len(rows) - cn < least)] = -1
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], (k, at))
        if best[1] is None:
            w = -rate * gs / (hs + ridge)
            f[rows] += w
            return float(w)
        k, at = best[1]
        low = coded[rows, k] <= at
        return (k, float(edges[k][at]), grow(rows[low], g, h, left - 1), grow(rows[~low], g, h, left - 1))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        out.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-9), depth))
    return base, out


def fit(labelled: DataFrame, url: str, blocked: str, sample: int = 20_000, trees: int = 24, depth: int = 3, rate: float = 0.3, buckets: int = 256, prior: float = 8.0) -> UrlModel:
    """labelled: URLs with a boolean column; rows where it or the URL is null teach nothing. Statistics cover all
    labelled rows. The trees see at most `sample` distinct URLs, the first by hash, each with the statistics of the other
    folds' URLs, so that no rate holds a row's own label; a repeated URL counts once there."""
    have = with_parts(labelled.filter(F.col(blocked).isNotNull() & F.col(url).isNotNull()).select(F.col(url).alias("url"), F.col(blocked).cast("int").alias("y")), "url")
    have = have.withColumn("fold", F.pmod(F.xxhash64(F.lit(2), "url"), F.lit(FOLDS)).cast("int"))
    have = have.withColumns({"suffix1": _suffix_bucket(F.col("host"), 1, buckets), "suffix2": _suffix_bucket(F.col("host"), 2, buckets), "first": _first(F.col("path"), buckets)})
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("b")) for k in STATS])).alias("e")
    sums = have.select("y", "fold", each).groupBy("e.k", "e.b", "fold").agg(F.sum("y").alias("p"), F.count("*").alias("n")).collect()  # 3 * buckets * FOLDS rows at most
    counted = {k: np.zeros((2, FOLDS, buckets)) for k in STATS}
    for r in sums:
        counted[r["k"]][:, r["fold"], r["b"]] = r["p"], r["n"]

    def rates(some: dict) -> dict[str, list[float]]:
        p, n = some["suffix1"].sum(1)
        rate0 = (p + 1) / (n + 2)
        return {k: ((v[0] + prior * rate0) / (v[1] + prior)).tolist() for k, v in some.items()}

    stats = rates({k: v.sum(1) for k, v in counted.items()})
    others = [rates({k: v.sum(1) - v[:, f] for k, v in counted.items()}) for f in range(FOLDS)]
    apart = {k: [x for f in range(FOLDS) for x in others[f][k]] for k in STATS}
    once = hash_sample(have.select("url", "y", "host", "path", "fold"), ["url", "y"], sample, distinct=True)
    rows = once.select(*[c.cast("double").alias(k) for k, c in features(F.col("url"), F.col("host"), F.col("path"), apart, F.col("fold")).items()], "y").collect()
    x = np.array([r[:-1] for r in rows], float).reshape(len(rows), len(FEATURES))
    base, grown = boost(x, np.array([r[-1] for r in rows], float), trees, depth, rate)
    return UrlModel(stats, base, grown)


def judge(df: DataFrame, url: str, model: UrlModel, rules=RULES) -> DataFrame:
    """df with host, path, rule, verdict and the model's margin. A null or empty URL, or one without "://", has empty
    parts and gets the model's verdict. Equal URLs, equal results; a margin of exactly 0 allows. Columns of df with these five
    names are replaced, all others stay, whatever their names."""
    host, path = _parts(F.col("url"))
    one = df.select(whole(df).alias("row"), F.col(url).alias("url")).select("row", "url", host.alias("host"), path.alias("path"))
    given = features(F.col("url"), F.col("host"), F.col("path"), model.stats)
    one = one.select("row", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("found"), *[c.alias(k) for k, c in given.items()])
    one = one.withColumn("margin", model.margin({k: F.col(k) for k in FEATURES}))
    said = F.coalesce(F.col("found.verdict"), F.when(F.col("margin") > 0, "block").otherwise("allow"))
    return one.select(*parts(df, "row", {"host", "path", "rule", "verdict", "margin"}), "host", "path", F.col("found.rule").alias("rule"), said.alias("verdict"), "margin")


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    """The labelled URLs are those that a rule decides; the trees judge the rest."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    known = with_parts(pages, "url").withColumn("r", rule_of(F.col("host"), F.col("path")))
    model = fit(known.select("url", (F.col("r.verdict") == "block").alias("blocked")), "url", "blocked")
    return judge(pages, "url", model).select("page_id", "host", "path", "rule", "verdict", "margin")
