"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, materialise, small, spread_join
from .empirical_bayes import above, shrink
from .shingles import texts_of

#: The classifier is fitted on at most so many labelled rows, those of smallest hashed id.
TRAIN_ROWS = 8_000
#: A word feature is in LEAST_ROWS rows of the sample, PURITY of them toxic, and by CHANCE deviations more than usual.
LEAST_ROWS, PURITY, CHANCE = 12, 0.95, 8.0
#: Documents are rejected from this posterior probability of being bad.
REJECT = 0.5

#: Scores are summed in whole parts of so many.
MILLION = 1_000_000

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'-|")
_EDGES = b".,;:!?\"'()[]{}<>*#$%&|"
_QUANTILES = (0.01, 0.03, 0.06, 0.12, 0.25, 0.5, 0.75, 0.88, 0.94, 0.97, 0.99)


def word_features(word: bytes) -> list[str]:
    """The word without marks at its ends, and its beginnings; whole characters."""
    core = word.strip(_EDGES).decode("utf-8", "replace")
    return [core, *(core[:n] + "~" for n in (4, 5, 6) if len(core) > n)] if core else []


def _shape(data: bytes, words: list[bytes]) -> list[float]:
    """Shares of capitals, marks, bars and non-ASCII bytes, repetition, word length, log length."""
    n = max(1, len(data))
    upper, lower = n - len(data.translate(None, _UPPER)), n - len(data.translate(None, _LOWER))
    again = max(sum(map(eq, words, words[lag:])) for lag in (1, 2, 3))  # words that stand 1 to 3 words before as well
    return [
        upper / max(1, upper + lower), (n - len(data.translate(None, _MARKS))) / n, data.count(b"|") / n,
        sum(map(data.count, (b"\xc3", b"\xc2"))) / n, again / max(1, len(words)),
        len(data) / max(1, len(words)), math.log1p(len(words)),
    ]


@dataclass
class Classifier:
    """Weights of toxic words, bin edges of each feature, and a weight for each bin."""

    words: dict[str, float]
    edges: list[list[float]]
    weights: list[float]
    base: float

    @cached_property
    def heads(self) -> set[bytes]:
        """The first four bytes of every feature; a shorter one has only its own."""
        return {x.encode()[:4] for x in self.words}

    def features(self, data: bytes) -> list[float]:
        evidence, heads, words = 0.0, self.heads, data.lower().split()
        for word in set(words):
            if word.strip(_EDGES)[:4] in heads:
                evidence += max((self.words.get(x, 0.0) for x in word_features(word)), default=0.0)
        return [evidence, *_shape(data, words)]

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        """One-hot bins, and a column of ones."""
        parts = [np.ones((len(rows), 1))]
        for column, edges in zip(rows.T, self.edges, strict=True):
            parts.append(np.eye(len(edges) + 1)[np.searchsorted(edges, column, "left")])
        return np.hstack(parts)

    def score(self, texts: list) -> np.ndarray:
        """The probability of being bad."""
        if not len(self.weights) or not texts:
            return np.full(len(texts), self.base)
        rows = np.array([self.features(t or b"") for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.matrix(rows) @ np.array(self.weights), -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge, by Newton's steps."""
    w = np.zeros(x.shape[1])
    ridge = np.r_[1e-6, np.ones(x.shape[1] - 1)]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, rows, toxic rows), summed within the task."""

    def flush(counts: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())],
            ["feature", "n", "toxic"],
        )

    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            for x in {f for w in set((text or b"").lower().split()) for f in word_features(w)}:
                c = counts.setdefault(x, [0, 0])
                c[0] += 1
                c[1] += toxic
            if len(counts) > 300_000:
                yield flush(counts)
                counts = {}
    if counts:
        yield flush(counts)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> Classifier:
    """Fit on a bounded sample; only word counts that pass the bar and one short row a document reach the driver."""
    sample = (
        labels.select(F.col("doc_id").alias("id"), "quality", "toxic").where("id is not null and quality is not null and toxic is not null")
        .orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("body")).join(F.broadcast(sample), "id")  # at most TRAIN_ROWS
    rows = materialise(rows.select("body", F.col("toxic").cast("int").alias("toxic"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad")), "sample")
    total, toxic, bad = rows.agg(F.count("*"), F.sum("toxic"), F.sum("bad")).first()
    base = (bad + 1) / (total + 2) if total else 0.0  # nothing known, nothing rejected
    if not bad or bad == total:
        return Classifier({}, [], [], base)
    rate = (toxic + 1) / (total + 2)
    counts = rows.select("body", "toxic").mapInArrow(_count_words, "feature string, n long, toxic long").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    chance = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    chosen = counts.where((F.col("n") >= LEAST_ROWS) & (F.col("toxic") >= PURITY * F.col("n")) & (chance >= CHANCE))
    words = {r.feature: math.log((r.toxic + 0.5) / (r.n - r.toxic + 0.5) * (1 - rate) / rate) for r in chosen.orderBy("feature").collect()}
    model = Classifier(words, [], [], base)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.features(t or b"") for t in texts_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], ["x", "bad"])

    described = rows.select("body", "bad").mapInArrow(describe, "x array<double>, bad int").collect()
    described.sort(key=lambda r: (r.x, r.bad))
    x, y = np.array([r.x for r in described]), np.array([r.bad for r in described], float)
    model.edges = [sorted(set(np.quantile(c, _QUANTILES, method="lower").tolist())) for c in x.T]
    model.edges[0] = [0.0, 6.0, 12.0]  # toxic evidence: none, little, some, much
    model.weights = _fit(model.matrix(x), y).tolist()
    return model


def scorer(model: Classifier):
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.score(texts_of(text)))

    return score


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _inside(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(1 / MILLION)), F.lit(1 - 1 / MILLION))


def _millionths() -> Column:
    return F.round(_inside(F.col("__fw_p")) * MILLION).cast("long")


def site_posteriors(scored: DataFrame) -> DataFrame:
    """What the posteriors of each site need: sums and prior strengths, a row a (__fw_host, __fw_path), written.

    Sums of __fw_p are of millionths of a document, so they don't depend on the order of addition; they are
    aggregated before the shuffle, and a host with a third of the rows is a row a task for each path.
    """
    host = "__fw_host"
    paths = scored.select(host, "__fw_path", _millionths().alias("p")).groupBy(host, "__fw_path").agg(
        F.count("*").alias("n"), (F.sum("p") / MILLION).alias("bad"))
    paths = materialise(paths, "paths")
    hosts = materialise(above(paths, [host]).withColumn("all", F.lit(1)), "hosts")
    whole = materialise(above(hosts, ["all"]).withColumn("mean", (F.col("bad") + 0.5) / (F.col("n") + 1)), "whole")
    hosts = materialise(shrink(hosts, whole, "all"), "host-posteriors")
    paths = materialise(shrink(paths, hosts, host), "path-posteriors")
    paths = paths.select(host, "__fw_path", *(F.col(c).alias(f"__fw_{c}") for c in ("n", "bad", "k")))
    hosts = hosts.select(host, "rows", *(F.col(c).alias(f"__fw_host_{c}") for c in ("n", "bad", "k")))
    out = spread_join(paths, hosts, [host], "rows").crossJoin(F.broadcast(whole.select(F.col("mean").alias("__fw_whole"))))  # one row
    return materialise(out, "posteriors")


def _with_posteriors(rows: DataFrame) -> DataFrame:
    """p_site and p_bad from a row of `site_posteriors`; the document's own score is left out of both levels."""
    own = _millionths() / MILLION

    def without(level: str, mean: Column) -> Column:
        n, bad, k = (F.col(f"__fw_{level}{c}") for c in ("n", "bad", "k"))
        return (mean * k + F.greatest(bad - own, F.lit(0.0))) / (k + n - 1)

    rows = rows.withColumn("p_site", _inside(without("", without("host_", F.col("__fw_whole")))))
    odds = _logit(_inside(F.col("__fw_p"))) + _logit(F.col("p_site")) - _logit(F.col("__fw_whole"))
    return rows.withColumn("p_bad", 1 / (1 + F.exp(-odds)))


def _scored(docs: DataFrame, labels: DataFrame, text: str, id_col: str, host: str, path: str, columns: list[str]) -> DataFrame:
    """The named columns of `docs` with score, site and a number a row, written: texts are scored once."""
    score = scorer(train(docs, labels, text, id_col))
    site = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((host, "__fw_host"), (path, "__fw_path"))]
    return materialise(docs.select(*columns, *site, score(F.col(text)).alias("__fw_p"), F.monotonically_increasing_id().alias("__fw_row")), "scored")


def _with_site(scored: DataFrame, posts: DataFrame) -> DataFrame:
    both, short = ["__fw_host", "__fw_path"], small(posts)
    return scored.join(short, both) if short is not posts else spread_join(scored, posts.withColumn("__fw_rows", F.col("__fw_n")), both, "__fw_rows")


def score_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", host: str = "source", path: str = "lang",
    columns: list[str] | None = None,
) -> DataFrame:
    """`columns` of `docs` (all unless given) with p_document, p_site and p_bad.

    p_document is the classifier's probability that the text is bad (of low quality, or toxic). Its sums
    over all documents, by host and by path within the host, go through beta-binomial shrinkage: a path
    towards its host, a host towards the corpus, the more the sparser they are. p_site is the posterior mean of
    the document's path from all other documents: its own score is left out of path and host, so that a
    lone document doesn't confirm itself. p_bad replaces the corpus's odds, which the classifier holds as its
    prior, by those of p_site.

    Texts are scored once, and written with their scores. The table of paths is broadcast if it is short; else
    the rows are joined to it, those of hot paths dealt to many tasks. Ask for narrow `columns` then.

    Nulls: a null text counts as empty; null hosts and paths are sites of their own, shared with empty
    ones. Without usable labels every document gets the same p_document. Labels that repeat an id count
    each, and rows that repeat an id are rows each. A very long text is scored whole. Empty tables give empty
    results. Other columns pass through; the three names replace columns of these names.
    """
    docs = docs.drop("p_document", "p_site", "p_bad")
    columns = columns or docs.columns
    scored = _scored(docs, labels, text, id_col, host, path, columns)
    rows = _with_posteriors(_with_site(scored, site_posteriors(scored)))
    return rows.select(*columns, F.col("__fw_p").alias("p_document"), "p_site", "p_bad")


def filter_quality(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", host: str = "source", path: str = "lang") -> DataFrame:
    """The rows of `docs` whose p_bad is below REJECT, as they are; see `score_documents`.

    Where the table of paths is too long to broadcast, the verdicts are found without the documents, and a key
    filter over the rejected rows' numbers says which documents have to meet them; the others stay where they are.
    """
    scored = _scored(docs, labels, text, id_col, host, path, docs.columns)
    posts = site_posteriors(scored)
    added = ["__fw_p", "__fw_host", "__fw_path"]
    if small(posts) is not posts:
        rows = _with_posteriors(_with_site(scored.select(F.struct(*docs.columns).alias("__fw_doc"), *added), posts))
        return rows.where(F.col("p_bad") < REJECT).select(*(F.col("__fw_doc").getField(c).alias(c) for c in docs.columns))
    judged = _with_posteriors(_with_site(scored.select("__fw_row", *added), posts))
    gone = materialise(judged.where(F.col("p_bad") >= REJECT).select("__fw_row"), "rejected")
    key = F.xxhash64("__fw_row")
    flagged = KeyFilter(gone.select(key.alias("key")), "key").flag(scored, key, "__fw_may")
    rest = flagged.where("__fw_may").join(gone, "__fw_row", "left_anti")
    return flagged.where("not __fw_may").select(*docs.columns).unionByName(rest.select(*docs.columns))
