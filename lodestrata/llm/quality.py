"""Quality of documents: a classifier's evidence combined with what is known of host and path.

The classifier gives each document a probability. A host's share of good
documents is estimated from all its documents and shrunk to the share of all
hosts; a path's share is shrunk to its host's. How strongly follows from how much
hosts, and paths within hosts, differ (empirical Bayes by moments), so a site with
few documents counts as its parent, and a large one as itself. The share of the
document's path, without the document, is then the prior of its own evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.arrow import map_batches
from lodestrata.llm import shingles
from lodestrata.llm.tables import stored

# The classifier is fitted on this many labelled rows at most.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
_SURE = 1e-6

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?"]] = True
_SIGN = ~(_LETTER | _DIGIT | _STOP | shingles.BLANK)
_SIGN[[ord(c) for c in "'\"()-"]] = False
FEATURES = (
    "log_words", "word_length", "letters", "capitals", "digits", "stops", "signs", "short_words",
    "distinct_words", "distinct_triples", "sign_words",
)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty or null text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    for first, last, data, offsets in shingles.slices(texts):
        hashes, lengths, starts = shingles.words(data, offsets)
        triples = shingles.grams(hashes, 3)
        sums = [np.concatenate(([0], np.cumsum(kind[data], dtype=np.int64)))
                for kind in (_LETTER, _UPPER, _DIGIT, _STOP, _SIGN, shingles.BLANK)]
        letters, upper, digits, stops, signs, blank = (s[offsets[1:]] - s[offsets[:-1]] for s in sums)
        solid = np.maximum(1, np.diff(offsets) - blank)
        n = np.diff(starts)
        some = np.maximum(1, n)
        length_sum = np.concatenate(([0], np.cumsum(lengths)))
        short_sum = np.concatenate(([0], np.cumsum(lengths <= 3)))
        rows = out[first:last]
        rows[:, 0] = np.log1p(n)
        rows[:, 1] = (length_sum[starts[1:]] - length_sum[starts[:-1]]) / some
        rows[:, 2] = letters / solid
        rows[:, 3] = upper / np.maximum(1, letters)
        rows[:, 4] = digits / solid
        rows[:, 5] = stops / some
        rows[:, 6] = signs / solid
        rows[:, 7] = (short_sum[starts[1:]] - short_sum[starts[:-1]]) / some
        for k in range(last - first):
            a, b = int(starts[k]), int(starts[k + 1])
            if b > a:
                rows[k, 8] = len(np.unique(hashes[a:b])) / (b - a)
            if b - a > 2:
                rows[k, 9] = len(np.unique(triples[a : b - 2])) / (b - a - 2)
        rows[:, 10] = signs / some
    return out


@dataclass(frozen=True)
class Classifier:
    """Logistic regression on standardised features and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    @staticmethod
    def _design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
        z = np.clip((x - mean) / scale, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z, z * z])

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> Classifier:
        """By Newton steps. Without rows, or with one class only, the share of good rows is all it knows."""
        prior = (y.sum() + 1.0) / (len(y) + 2.0)
        mean = x.mean(0) if len(x) else np.zeros(len(FEATURES))
        scale = np.maximum(x.std(0), 1e-6) if len(x) else np.ones(len(FEATURES))
        design = cls._design(x, mean, scale)
        weights = np.zeros(2 * len(FEATURES) + 1)
        weights[0] = np.log(prior / (1 - prior))
        if 0 < y.sum() < len(y):
            ridge = np.full(len(weights), penalty)
            ridge[0] = 0.0
            for _ in range(steps):
                p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
                slope = design.T @ (y - p) - ridge * weights
                curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge + 1e-9)
                move = np.linalg.solve(curve, slope)
                weights += move
                if np.abs(move).max() < 1e-8:
                    break
        return cls(mean, scale, weights, float(prior))

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self._design(x, self.mean, self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> Classifier:
    """The classifier from ``sample_rows`` labelled documents at most, those with the smallest digests of the id.

    Labels other than 0 and 1, and rows with null ids, are not used. Of several
    labels of one document the smallest counts.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.min(label_col).alias("__label"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(sample_rows)
    schema = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(
                    pa.list_(pa.float64()))], names=["y", "x"])

    # At most ``sample_rows`` ids and labels are broadcast, so no text is shuffled.
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(
        F.col("__label").cast("double"), text_col)
    sample = map_batches(rows, measured, schema).toPandas()
    x = np.array(sample["x"].tolist(), float).reshape(len(sample), len(FEATURES))
    y = sample["y"].to_numpy(float)
    order = np.lexsort(np.vstack([x.T, y]))
    return Classifier.fit(x[order], y[order])


def scored(
    docs: DataFrame, model: Classifier, columns: list[Column], text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """``columns`` of ``docs``, ``__text`` if asked for, and ``evidence``, the classifier's probability.

    Nothing is shuffled.
    """
    chosen = docs.select(*columns, F.col(text_col).alias("__text"))
    left = len(chosen.columns) - (not with_text)
    schema = T.StructType([*chosen.schema.fields[:left], T.StructField("evidence", T.DoubleType())])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.probability(features(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:left], pa.array(p)], names=schema.names)

    return map_batches(chosen, judged, schema)


def _strength(groups: DataFrame, mean: Column) -> float:
    """How many documents the parent's share is worth: within-group over between-group variance."""
    row = groups.agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - mean, 2)).alias("between"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"),
    ).first()
    if not row["g"] or row["n"] <= row["g"] or row["g"] < 2:
        return 1e9
    within = max(row["within"], 0.0) / (row["n"] - row["g"])
    spread = (row["between"] - (row["g"] - 1) * within) / (row["n"] - row["nn"] / row["n"])
    return float(np.clip(within / spread, 1.0, 1e9)) if spread > 0 else 1e9


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_SURE)), F.lit(1 - _SURE))
    return F.log(p / (1 - p))


def site_sums(evidence: DataFrame) -> tuple[DataFrame, dict[str, float | None]]:
    """Sums of each (host, path) and of its host, and how they are shrunk.

    These sums are the only shuffle of all rows, and they are combined before it.
    """
    sums = [F.count(F.lit(1)).alias("n"), F.sum("evidence").alias("s"), F.sum(F.col("evidence") ** 2).alias("q")]
    paths = stored(evidence.groupBy("host", "path").agg(*sums), "quality-paths")
    hosts = stored(paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")]), "quality-hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    share = total["s"] / total["n"] if total["n"] else 0.5
    of_host = hosts.select(F.col("host").alias("h"), F.col("n").alias("hn"), F.col("s").alias("hs"))
    sites = paths.join(of_host, paths.host.eqNullSafe(of_host.h)).drop("h")
    return sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "n", "s", "hn", "hs"), {
        "share": share,
        "host": _strength(hosts, F.lit(share)),
        "path": _strength(sites, F.col("hs") / F.col("hn")),
    }


def with_posteriors(rows: DataFrame, sites: DataFrame, shrink: dict, prior: float, threshold: float) -> DataFrame:
    """``rows`` (host, path, evidence and more) with host_share, path_share, score and kept."""
    own, host, path = F.col("evidence"), shrink["host"], shrink["path"]
    host_share = (F.col("hs") - own + host * shrink["share"]) / (F.col("hn") - 1 + host)
    path_share = (F.col("s") - own + path * F.col("host_share")) / (F.col("n") - 1 + path)
    joined = rows.join(sites, rows.host.eqNullSafe(F.col("h")) & rows.path.eqNullSafe(F.col("p")))
    z = _logit(own) - _logit(F.lit(prior)) + _logit(F.col("path_share"))
    return (
        joined.withColumn("host_share", host_share).withColumn("path_share", path_share)
        .withColumn("score", 1 / (1 + F.exp(-z)))
        .withColumn("kept", F.col("score") >= threshold)
        .drop("h", "p", "n", "s", "hn", "hs")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, evidence, host_share, path_share, score, kept.

    A null or empty text is judged by features that are all zero. Null hosts are
    one host, null paths one path. Repeated rows count one each, null ids stay.
    Without usable labels the evidence is one half for all. Other columns are not
    read. All documents count in the shares of sites; only the fit uses a sample.
    """
    model = fit(docs, labels, id_col, text_col, label_col, sample_rows)
    columns = [F.col(id_col).alias("row_id"), F.col(host_col).cast("string").alias("host"),
               F.col(path_col).cast("string").alias("path")]
    evidence = stored(scored(docs, model, columns, text_col), "quality-evidence")
    sites, shrink = site_sums(evidence)
    return with_posteriors(evidence, sites, shrink, model.prior, threshold).select(
        F.col("row_id").alias(id_col), "evidence", "host_share", "path_share", "score", "kept")


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    path_col: str = "lang", label_col: str = "quality", threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns.

    The classifier runs twice, for the sums and for the rows, so that no text is
    written in between; only the sums of sites meet the rows.
    """
    model = fit(docs, labels, id_col, text_col, label_col, sample_rows)
    site = [F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path")]
    sites, shrink = site_sums(stored(scored(docs, model, site, text_col), "quality-evidence"))
    others = [c for c in docs.columns if c != text_col]
    whole = F.struct(F.lit(True).alias("row"), *[docs[c].alias(f"c{k}") for k, c in enumerate(others)]).alias("whole")
    rows = with_posteriors(
        scored(docs, model, [whole, *site], text_col, True), sites, shrink, model.prior, threshold).filter("kept")
    named = {c: F.col(f"whole.c{k}") for k, c in enumerate(others)} | {text_col: F.col("__text")}
    return rows.select(*[named[c].alias(c) for c in docs.columns])
