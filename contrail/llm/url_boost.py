"""URL filter: ordered allow / block rules, then gradient-boosted trees.

A rule is a host and a path prefix; it fits its host, all subdomains and
every path that starts with its path, and the longest fitting rule decides.
Other URLs are judged by boosted trees over lexical features: length, depth,
digit ratio, entropy, parameter counts, hyphens, and statistics of the host's
suffixes learned from the labelled URLs.

Labels are positive and unlabelled: a URL is labelled unwanted if its host has a
word of ``SEEDS``, and either way if a table of the caller says so; all others are
unlabelled, not good.  Rules are policy (a zone, a language), decide their URLs
before the trees and teach them nothing.  The unlabelled URLs are scored by trees
that have seen no URL of their host (``FOLDS`` folds by host, both classes weighing
the same); those that look unwanted there are left out of the final training, so a
family of hosts that the seeds do not name is not learned as good; this is done
again without them until no more are found (at most ``SCREENS`` times).  The suffix
statistics of a training URL come from the other folds, too.  Training reads at most
``SAMPLE`` URLs (smallest hash).

Defined cases: a null URL, or one without ``://``, has an empty host and path
and fits no rule; of rules of equal length that fit, the last by name decides;
without unwanted and other URLs every URL that no rule fits is allowed; an empty
table gives no rows; URLs are read whole, however long; rows are independent and
repeated rows repeat their result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.sampling import bounded

SAMPLE, FOLDS, SCREENS = 20_000, 4, 4
#: Host words of unwanted sites, as public block lists name them.
SEEDS = ("ads", "adult", "banner", "bet", "casino", "cheap", "cialis", "click", "escort", "gambling", "loan",
         "lottery", "pills", "poker", "porn", "replica", "sex", "slots", "spam", "torrent", "track", "viagra",
         "warez", "win", "xxx")
FEATURES = ("length", "host_length", "labels", "depth", "longest_label", "digits", "host_digits", "hyphens",
            "host_entropy", "path_entropy", "parameters", "query_length", "fragment", "extension", "vowels",
            "suffix_rate", "zone_rate")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("net", "/", True), Rule("example.net", "/en/", False), Rule("example.com", "/de/", True),
         Rule("org", "/fr/", False))


def host_column(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(raw, upper, upper.lower()), F.lit(""))


def path_column(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, block) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,block:boolean>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.block).alias("block"))).otherwise(out)
    return out


def _entropy(s: str) -> float:
    if not s:
        return 0.0
    n = np.unique(np.frombuffer(s.encode("utf-32-le"), np.uint32), return_counts=True)[1] / len(s)
    return float(-(n * np.log2(n)).sum())


def _suffixes(host: str) -> tuple[str, str]:
    labels = host.split(".")
    return ".".join(labels[-2:]), labels[-1]


@dataclass
class Model:
    prior: float = 0.0
    suffix: dict = field(default_factory=dict)      # suffix -> smoothed share of blocked URLs
    start: float = 0.0
    trees: list = field(default_factory=list)       # (feature, threshold, value) arrays, heap order
    constant: bool = True

    def rates(self, hosts) -> np.ndarray:
        """Share of unwanted URLs among those of the host's two suffixes."""
        return np.array([[self.suffix.get(s, self.prior) for s in _suffixes(h)] for h in hosts]).reshape(-1, 2)

    def features(self, urls, hosts, paths) -> np.ndarray:
        out = np.zeros((len(urls), len(FEATURES)))
        for k, (u, h, p) in enumerate(zip(urls, hosts, paths)):
            u, labels = u or "", h.split(".")
            after = u.split("://", 1)[-1]
            query = after.split("#", 1)[0].partition("?")[2]
            own = ".".join(labels[:-2]) or h
            n = max(len(u), 1)
            out[k, :-2] = (len(u), len(h), len(labels), sum(1 for s in p.split("/") if s), max(map(len, labels)),
                      sum(c.isdigit() for c in u) / n, sum(c.isdigit() for c in h) / max(len(h), 1),
                      h.count("-"), _entropy(own), _entropy(p),
                      sum(1 for s in query.split("&") if s), len(query), "#" in after,
                      "." in p.rsplit("/", 1)[-1], sum(c in "aeiou" for c in own) / max(len(own), 1))
        out[:, -2:] = self.rates(hosts)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for feature, threshold, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                left = x[np.arange(len(x)), np.maximum(feature[node], 0)] <= threshold[node]
                node = np.where(inner, 2 * node + np.where(left, 1, 2), node)
            z += value[node]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _grow(bins, edges, g, h, depth: int, columns, lam: float = 1.0, least: float = 1.0):
    """One tree by histograms of the slopes, level by level."""
    size = (1 << (depth + 1)) - 1
    feature, threshold, value = np.full(size, -1), np.zeros(size), np.zeros(size)
    node = np.zeros(len(g), np.int64)
    for at in range(size):
        own = np.flatnonzero(node == at)
        if len(own) == 0:
            continue
        gs, hs = g[own], h[own]
        value[at] = -gs.sum() / (hs.sum() + lam)
        if at >= (1 << depth) - 1:
            continue
        best = (1e-6, -1, 0)
        for f in columns:
            b, n = bins[f], len(edges[f]) + 1
            if n < 2:
                continue
            gl = np.cumsum(np.bincount(b[own], gs, n))[:-1]
            hl = np.cumsum(np.bincount(b[own], hs, n))[:-1]
            gain = gl**2 / (hl + lam) + (gs.sum() - gl)**2 / (hs.sum() - hl + lam) - gs.sum()**2 / (hs.sum() + lam)
            gain[(hl < least) | (hs.sum() - hl < least)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
        if best[1] >= 0:
            _, f, k = best
            feature[at], threshold[at] = f, edges[f][k]
            node[own] = 2 * at + np.where(bins[f][own] <= k, 1, 2)
    return feature, threshold, value


def suffix_rates(hosts, y) -> tuple[float, dict]:
    """Share of unwanted URLs, overall and smoothed by suffix."""
    prior, counts = float(np.mean(y)) if len(y) else 0.0, {}
    for h, v in zip(hosts, y):
        for s in _suffixes(h):
            c = counts.setdefault(s, [0.0, 0.0])
            c[0] += v
            c[1] += 1
    return prior, {s: (a + 20 * prior) / (n + 20) for s, (a, n) in counts.items()}


def _out_of_fold(x: np.ndarray, hosts, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """``x`` with the suffix statistics of the other folds' URLs."""
    x, hosts = x.copy(), np.array(hosts, object)
    for f in np.unique(fold):
        x[fold == f, -2:] = Model(*suffix_rates(hosts[fold != f], y[fold != f])).rates(hosts[fold == f])
    return x


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2,
          max_bins: int = 64) -> Model:
    """Boosted trees by the slopes of the weighted log loss.  A tree sees half of the
    features (drawn from a fixed seed): where several separate the labelled hosts alike,
    all of them have a say about a new one."""
    draw = np.random.default_rng(17)
    edges = [np.unique(np.quantile(x[:, k], np.arange(1, max_bins) / max_bins)) for k in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)]
    p = float(np.average(y, weights=weight))
    m = Model(start=float(np.log(p / (1 - p))), constant=False)
    z = np.full(len(y), m.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        columns = draw.permutation(x.shape[1])[:(x.shape[1] + 1) // 2]
        feature, threshold, value = _grow(bins, edges, weight * (p - y), np.maximum(weight * p * (1 - p), 1e-6), depth, columns)
        m.trees.append((feature, threshold, rate * value))
        q = Model(trees=m.trees[-1:]).score(x)
        z += np.log(q / (1 - q))
    return m


def _host_weights(hosts) -> np.ndarray:
    """A host weighs 1, shared by its URLs: a hundred pages of one host are no
    hundred witnesses."""
    _, at, n = np.unique(np.array(hosts, object).astype(str), return_inverse=True, return_counts=True)
    return 1 / n[at]


def _balanced(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``w`` with both classes weighing the same."""
    return w * w.sum() / 2 / np.where(y == 1, w[y == 1].sum(), w[y == 0].sum())


def train(urls, hosts, paths, labels, rounds: int = 60) -> Model:
    """Trees from labels 1 (unwanted), 0 (good by a caller's table) and None."""
    known = np.array([v is not None for v in labels], bool)
    y = np.array([v or 0 for v in labels], dtype=float)
    if len(y) == 0 or y.min() == y.max():
        return Model()
    fold = np.array([zlib.crc32(h.encode()) % FOLDS for h in hosts])
    base = Model().features(urls, hosts, paths)
    x = _out_of_fold(base, hosts, y, fold)
    w, keep = _host_weights(hosts), np.ones(len(y), bool)
    for _ in range(SCREENS):
        # two steps deep and without the suffixes: what the named families have in common
        found = keep.copy()
        for f in np.unique(fold):
            own, rest = fold == f, (fold != f) & keep
            if rest.any() and 0 < y[rest].sum() < rest.sum():
                unseen = boost(x[rest, :-2], y[rest], _balanced(y[rest], w[rest]), rounds // 2, depth=2).score(x[own, :-2])
                found[own] &= known[own] | (unseen < 0.5)
        if found.sum() == keep.sum():
            break
        keep = found
    if y[keep].min() == y[keep].max():
        keep[:] = True
    hosts, y, fold, w = [h for h, k in zip(hosts, keep) if k], y[keep], fold[keep], w[keep]
    m = boost(_out_of_fold(base[keep], hosts, y, fold), y, _balanced(y, w), rounds)
    m.prior, m.suffix = suffix_rates(hosts, y)
    return m


def labelled(parsed: DataFrame, labels: DataFrame | None = None, seeds=SEEDS) -> DataFrame:
    """url, host, path, label (null: unlabelled) of the URLs to learn from."""
    words = F.split(F.regexp_replace("host", "[^a-z0-9]+", " "), " ")
    seeded = F.arrays_overlap(words, F.array(*[F.lit(s) for s in seeds]))
    rows = parsed.where("fit IS NULL").select("url", "host", "path", F.when(seeded, 1).alias("label"))
    if labels is not None:
        given = (labels.where("url IS NOT NULL AND label IS NOT NULL").groupBy("url").agg(F.max("label").alias("given")))
        rows = rows.join(given, "url", "left").withColumn(
            "label", F.coalesce(F.col("given").cast("int"), "label")).drop("given")
    return rows.where("url IS NOT NULL AND host <> ''")


def parse(pages: DataFrame, key: str = "page_id", rules=RULES) -> DataFrame:
    p = pages.select(key, "url", host_column(F.col("url")).alias("host"), path_column(F.col("url")).alias("path"))
    return p.withColumn("fit", rule_column(F.col("host"), F.col("path"), rules))


def fit(pages: DataFrame, labels: DataFrame | None = None, key: str = "page_id", rules=RULES,
        sample: int = SAMPLE) -> Model:
    rows = bounded(labelled(parse(pages, key, rules), labels).dropDuplicates(["url"]), ["url"], sample).collect()
    return train([r.url for r in rows], [r.host for r in rows], [r.path for r in rows], [r.label for r in rows])


def judge(pages: DataFrame, model: Model, key: str = "page_id", rules=RULES) -> DataFrame:
    """key, host, path, rule, verdict, score (of the trees; null under a rule)."""
    @F.arrow_udf("double")
    def score(urls: pa.Array, hosts: pa.Array, paths: pa.Array) -> pa.Array:
        if model.constant:
            return pa.array(np.zeros(len(urls)))
        return pa.array(model.score(model.features(urls.to_pylist(), hosts.to_pylist(), paths.to_pylist())))

    p = parse(pages, key, rules).withColumn("score", score("url", "host", "path"))
    blocked = F.coalesce(F.col("fit.block"), F.col("score") >= 0.5)
    return p.select(key, "host", "path", F.col("fit.rule").alias("rule"),
                    F.when(blocked, "block").otherwise("allow").alias("verdict"),
                    F.when(F.col("fit").isNull(), F.col("score")).alias("score"))
