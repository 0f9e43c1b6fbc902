"""Quality classifier: document evidence with hierarchical empirical Bayes.

1. Evidence: a logistic regression on simple text features, trained in numpy on
   a bounded sample of labelled documents (``MAX_SAMPLE``, chosen by a hash of
   doc_id), gives each document a probability of being good.
2. Sites: a document's host is its ``source``, its path ``source`` and ``lang``.
   Grouped sums of the evidence give each host a posterior mean: a Beta prior
   around the global mean, as strong as the spread of hosts says (by moments),
   plus what the host's documents say; a path shrinks in the same way towards
   its host.  Sparse sites stay near their prior, large ones near their mean.
3. The document's log-odds move by its path's log-odds against the global mean,
   halved: the site is evidence, but the text decides.

Null or empty text has evidence from its zero features; null source or lang is a
site of its own.  Without labels of both kinds the evidence is 0.5 throughout.
Rows, also repeated ones, are judged one by one; an empty table gives an empty
result; other columns are ignored.  Sums are grouped with partial aggregates, so
a host with a third of all rows costs one row a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm import text as T
from kassa.llm.quality_rules import SYMBOLS, _repeated_words
from kassa.llm.store import save

MAX_SAMPLE = 20_000
SITE_WEIGHT = 0.5
KEEP = 0.5
FEATURES = ("log_words", "word_length", "symbols", "repeated", "short_words", "capitals", "digits", "sentences")


def text_features(block: T.Block) -> np.ndarray:
    """One row a document, columns as in FEATURES."""
    data, starts, ends = block.data, block.starts, block.ends
    first, last, bounds = T.word_spans(data, starts, ends, T.NOT_SPACE)
    n = np.diff(bounds)
    some = np.maximum(n, 1)

    def share(table):
        sums = np.append(0, np.cumsum(table[data]))
        return (sums[ends] - sums[starts]) / np.maximum(ends - starts, 1)

    sizes = np.append(0, np.cumsum(last - first))
    short = np.append(0, np.cumsum(last - first <= 2))
    stops = np.append(0, np.cumsum(np.isin(data[np.maximum(last - 1, 0)], np.frombuffer(b".!?", np.uint8))))
    return np.stack(
        [
            np.log1p(n),
            (sizes[bounds[1:]] - sizes[bounds[:-1]]) / some,
            np.minimum(share(T.byte_class(SYMBOLS)) * 10, 3),
            _repeated_words(T.word_hashes(data, first, last), bounds) / some,
            (short[bounds[1:]] - short[bounds[:-1]]) / some,
            share(T.byte_class(range(65, 91))) * 5,
            share(T.byte_class(range(48, 58))) * 5,
            np.minimum((stops[bounds[1:]] - stops[bounds[:-1]]) / some * 5, 3),
        ],
        axis=1,
    )


def _extract(batches):
    for block in T.blocks(batches):
        values = text_features(block)
        yield pa.RecordBatch.from_arrays(
            [
                *(block.batch.column(i) for i in range(3)),
                *(pa.array(values[:, k]) for k in range(len(FEATURES))),
            ],
            names=["doc_id", "source", "lang", *FEATURES],
        )


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and, last, the constant, by Newton's method; a quadratic of each
    feature is added, as too much can be as bad as too little."""
    x = _widen(x)
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _widen(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, x * x])


def _sites(rows: DataFrame, keys: list[str], mean, name: str) -> DataFrame:
    """Sums of the evidence by site: n, total, squares around the prior mean."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias(f"n_{name}"),
        F.sum("p_doc").alias(f"total_{name}"),
        F.sum((F.col("p_doc") - mean) * (F.col("p_doc") - mean)).alias(f"squares_{name}"),
    )


def _strength(n: int, between: float, within: float) -> float:
    """Prior strength in documents: within-site variance per unit of between-site."""
    if n < 2 or between <= 0:
        return 1e6
    return float(np.clip(within / between, 1.0, 1e6))


def classify(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """doc_id, p_doc, p_host, p_path, score (doubles in 0..1), kept."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    schema = "doc_id long, source string, lang string, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = save(source.mapInArrow(_extract, schema), "quality-features")
    picked = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .select("doc_id", "quality")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_sample)
    )
    # at most max_sample rows of numbers: a proven bound
    sample = sorted(map(tuple, rows.join(F.broadcast(picked), "doc_id").select("doc_id", "quality", *FEATURES).collect()))
    x = np.array([r[2:] for r in sample], float).reshape(-1, len(FEATURES))
    y = np.array([r[1] for r in sample], float)
    if len(set(y.tolist())) == 2:
        weights = fit_logistic(x, y)
        linear = F.lit(float(weights[-1]))
        for k, name in enumerate(FEATURES):
            value = F.col(name)
            linear = linear + value * float(weights[k]) + value * value * float(weights[len(FEATURES) + k])
        evidence = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), linear))))
    else:
        evidence = F.lit(0.5)
    rows = rows.select("doc_id", "source", "lang", evidence.alias("p_doc"))

    mean = rows.agg(F.avg("p_doc")).first()[0]
    mean = float(np.clip(0.5 if mean is None else mean, 0.01, 0.99))
    paths = save(_sites(rows, ["source", "lang"], F.lit(mean), "path"), "quality-paths")
    hosts = save(
        paths.groupBy("source").agg(
            F.sum("n_path").alias("n_host"),
            F.sum("total_path").alias("total_host"),
            F.sum("squares_path").alias("squares_host"),
        ),
        "quality-hosts",
    )

    def strength(sites: DataFrame, name: str) -> float:
        n, total, squares = F.col(f"n_{name}"), F.col(f"total_{name}"), F.col(f"squares_{name}")
        gap = total / n - mean
        own = squares - n * gap * gap  # within the site
        k, within, all_n, spread = sites.agg(
            F.count("*"), F.sum(own), F.sum(n), F.sum(n * gap * gap)
        ).first()
        if not k or all_n <= k:
            return 1e6
        inside = within / (all_n - k)
        return _strength(k, (spread - k * inside) / all_n, inside)

    a_host, a_path = strength(hosts, "host"), strength(paths, "path")
    host = hosts.select("source", ((F.col("total_host") + a_host * mean) / (F.col("n_host") + a_host)).alias("p_host"))
    site = paths.join(host, paths["source"].eqNullSafe(host["source"])).select(
        paths["source"],
        "lang",
        "p_host",
        ((F.col("total_path") + a_path * F.col("p_host")) / (F.col("n_path") + a_path)).alias("p_path"),
    )

    def odds(p):
        p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
        return F.log(p / (1 - p))

    site = site.select(F.col("source").alias("s"), F.col("lang").alias("l"), "p_host", "p_path")
    joined = rows.join(site, F.col("source").eqNullSafe(F.col("s")) & F.col("lang").eqNullSafe(F.col("l")), "left")
    moved = odds(F.col("p_doc")) + SITE_WEIGHT * (odds(F.col("p_path")) - odds(F.lit(mean)))
    score = 1 / (1 + F.exp(-moved))
    return joined.select("doc_id", "p_doc", "p_host", "p_path", score.alias("score")).withColumn(
        "kept", F.col("score") >= KEEP
    )
