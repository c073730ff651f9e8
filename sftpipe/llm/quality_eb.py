"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic regression on a document's characters and words gives its evidence, as log odds.
Sites add what their other documents say: the share of good documents of a host is shrunk
toward the global share, and that of a path toward its host's, each the more the fewer
documents it has. How much is estimated from the data, by the variance between groups
against that within them. A document counts with its label if it has one that may be
learned from, else with its classifier probability; it does not count for itself. Evidence
and the path's prior odds make the posterior, and a document is kept from
``KEEP`` on.

The regression is fitted on a bounded sample of ``SAMPLE_ROWS`` labelled rows, those with the
smallest hashes. Counts of hosts and paths cover all rows and are grouped before they are
shuffled, so a host with a third of all rows is one row per task.

Defined cases: null and empty texts have only the constant feature; a null host or path is a
group of its own; a null key has no label; of several labels of a key their mean counts;
without labels all evidence is 0, all rates are 1/2, and all documents are kept; repeated
rows count as often as they come; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftpipe.llm.common import filled, id_text, map_texts
from sftpipe.operators.joins import without_keys
from sftpipe.session import write_counted, write_stage

SAMPLE_ROWS = 20_000
RIDGE = 1.0
KEEP = 0.5
#: Bounds of the prior's weight in documents, and of probabilities.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6
EPSILON = 1e-6

#: Each byte's class: ASCII marks one by one, and ten wider ones.
_CLASSES = np.zeros(256, np.int64)
for _byte in range(256):
    _c = chr(_byte)
    _CLASSES[_byte] = (
        0 if _byte >= 0x80
        else 1 if _c.islower()
        else 2 if _c.isupper()
        else 3 if _c.isdigit()
        else 4 if _c == " "
        else 5 if _c == "\n"
        else 6 if not _c.isprintable()
        else 7 + sorted("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").index(_c)
    )
_N_CLASSES = int(_CLASSES.max()) + 1
FEATURES = _N_CLASSES + 4


def features(text: str) -> list[float]:
    """Roots of the shares of byte classes, of words that repeat the one before, of different
    words in stretches of a hundred, the mean length of words, and a constant."""
    data = np.frombuffer(text.encode(), np.uint8)
    words = text.split()
    counts = np.bincount(_CLASSES[data], minlength=_N_CLASSES) if len(data) else np.zeros(_N_CLASSES)
    shares = np.sqrt(counts / max(len(data), 1))
    repeats = sum(map(eq, words, words[1:])) / max(len(words) - 1, 1)
    stretches = [words[i : i + 100] for i in range(0, len(words), 100)]
    distinct = sum(len(set(s)) for s in stretches) / max(len(words), 1)
    length = min(len(text) / max(len(words), 1), 40.0) / 10
    return [*shares.tolist(), repeats**0.5, distinct, length, 1.0]


def fit(rows: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last is the constant's.

    Features are standardised for the fit and the weights turned back.
    """
    if not len(rows):
        return np.zeros(FEATURES)
    mean, spread = rows.mean(axis=0), rows.std(axis=0)
    spread[spread < 1e-9] = 1.0
    mean[-1], spread[-1] = 0.0, 1.0
    rows = (rows - mean) / spread
    weights = np.zeros(rows.shape[1])
    ridge = np.full(rows.shape[1], RIDGE)
    ridge[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (good - p) - ridge * weights
        curvature = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    weights /= spread
    weights[-1] -= weights[:-1] @ mean[:-1]
    return weights


def learn(df: DataFrame, key: str, text: str, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights from the labelled rows of ``df``; ``labels`` has ``key`` and ``good``."""
    sample = labels.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    # Bounded by the sample's size.
    read = df.select(df[key].alias("key"), filled(df[text]).alias("text")).join(F.broadcast(sample), "key")

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            yield [(g, features(t)) for g, t in zip(batch["good"], batch["text"])]

    # A key may repeat in the documents: of its texts the one with the smallest hash is learned
    # from, as a key counts once.
    place = F.struct(F.xxhash64("text"), "text")
    texts = read.groupBy("key", "good").agg(F.min_by("text", place).alias("text"))
    kept = map_texts(texts.select("good", "text"), "good double, x array<double>", rows).collect()
    if not kept:
        return fit(np.zeros((0, FEATURES)), np.zeros(0))
    order = np.array([[r["good"], *r["x"]] for r in kept])
    order = order[np.lexsort(order.T[::-1])]
    return fit(order[:, 1:], order[:, 0])


def evidence(df: DataFrame, key: str, text: str, weights: np.ndarray, *more: Column) -> DataFrame:
    """``key``, the columns ``more`` and ``evidence``, the classifier's log odds."""
    names = df.select(*more).columns
    kinds = [f.dataType.simpleString() for f in df.select(*more).schema]

    def rows(batches: Iterator[dict]) -> Iterator[list[tuple]]:
        for batch in batches:
            found = np.array([features(t) for t in batch["text"]]).reshape(-1, FEATURES) @ weights
            others = [batch[n] for n in names]
            yield list(zip(batch["key"], *others, np.clip(found, -30, 30).tolist()))

    kind = df.schema[key].dataType.simpleString()
    schema = ", ".join([f"key {kind}", *(f"{n} {k}" for n, k in zip(names, kinds)), "evidence double"])
    read = df.select(df[key].alias("key"), *more, filled(df[text]).alias("text"))
    return map_texts(read, schema, rows)


def prior_weight(groups: int, rows: float, squares: float, between: float, total: float) -> float:
    """Documents that a group's prior is worth, by analysis of variance.

    ``squares`` sums the squared group sizes, ``between`` size times squared mean, ``total``
    the squared values.
    """
    if groups < 2 or rows <= groups:
        return MOST_WEIGHT
    # The caller has taken the parent's mean off all values.
    inside = max((total - between) / (rows - groups), 1e-12)
    size = (rows - squares / rows) / (groups - 1)
    share = (between / (groups - 1) - inside) / (between / (groups - 1) + (size - 1) * inside)
    return min(max(1 / share - 1, LEAST_WEIGHT), MOST_WEIGHT) if share > 0 else MOST_WEIGHT


def _group(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def logit(p: Column) -> Column:
    safe = F.greatest(F.least(p, F.lit(1 - EPSILON)), F.lit(EPSILON))
    return F.log(safe / (1 - safe))


def posteriors(scored: DataFrame) -> DataFrame:
    """``key``, ``evidence``, ``host_rate``, ``path_rate``, ``posterior``.

    ``scored`` has ``key``, ``host``, ``path``, ``good`` (null without a label) and
    ``evidence``; ``path`` counts within its host.
    """
    value = F.coalesce(F.col("good"), 1 / (1 + F.exp(-F.col("evidence"))))
    docs = write_stage(
        scored.select("key", "evidence", "good", value.alias("y"), _group(F.col("host")).alias("host"), _group(F.col("path")).alias("path")),
        "quality-values",
    )
    paths = docs.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("path_n"), F.sum("y").alias("path_sum"), F.sum(F.col("y") * F.col("y")).alias("path_square")
    )
    hosts = paths.groupBy("host").agg(
        F.sum("path_n").alias("host_n"), F.sum("path_sum").alias("host_sum"), F.sum("path_square").alias("host_square"),
    )
    sites = write_stage(paths.join(hosts, "host"), "quality-sites")
    labelled = docs.agg(F.avg("good").alias("rate")).first()["rate"]
    # What the regression has learned as its own prior.
    learned = 0.5 if labelled is None else min(max(labelled, EPSILON), 1 - EPSILON)
    whole = sites.agg(F.sum("path_n").alias("n"), F.sum("path_sum").alias("s"), F.sum("path_square").alias("q")).first()
    n, total = whole["n"] or 0, whole["s"] or 0.0
    rate = total / n if n else 0.5

    def weight(table: DataFrame, size: str, s: str, q: str, center: Column) -> float:
        mean = F.col(s) / F.col(size) - center
        square = F.col(q) - 2 * center * F.col(s) + F.col(size) * center * center
        r = table.agg(
            F.count(F.lit(1)).alias("groups"), F.sum(size).alias("rows"), F.sum(F.col(size) * F.col(size)).alias("squares"),
            F.sum(F.col(size) * mean * mean).alias("between"), F.sum(square).alias("total"),
        ).first()
        return prior_weight(*(float(x or 0) for x in r))

    host_table = sites.select("host", "host_n", "host_sum", "host_square").distinct()
    host_weight = weight(host_table, "host_n", "host_sum", "host_square", F.lit(rate))
    path_weight = weight(sites, "path_n", "path_sum", "path_square", F.col("host_sum") / F.col("host_n"))

    y = F.col("y")
    joined = docs.join(sites, ["host", "path"])
    with_host = joined.withColumn(
        "host_rate", (F.col("host_sum") - y + host_weight * rate) / (F.col("host_n") - 1 + host_weight)
    )
    with_path = with_host.withColumn(
        "path_rate", (F.col("path_sum") - y + path_weight * F.col("host_rate")) / (F.col("path_n") - 1 + path_weight)
    )
    odds = F.col("evidence") - F.lit(float(np.log(learned / (1 - learned)))) + logit(F.col("path_rate"))
    return with_path.select("key", "evidence", "host_rate", "path_rate", (1 / (1 + F.exp(-odds))).alias("posterior"))


def classify(
    df: DataFrame, key: str, text: str, host: str, path: str, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Per row: ``key``, ``evidence``, ``host_rate``, ``path_rate``, ``posterior``, ``kept``.

    ``labels`` has a key and a number, 1 for good and 0 for bad.
    """
    label_key, good = labels.columns
    known = write_stage(
        labels.select(F.col(label_key).alias("key"), F.col(good).cast("double").alias("good"))
        .filter("key IS NOT NULL AND good IS NOT NULL")
        .groupBy("key")
        .agg(F.avg("good").alias("good")),
        "quality-labels",
    )
    weights = learn(df, key, text, known.select("key", F.round("good").alias("good")), sample_rows)
    scored = evidence(
        df, key, text, weights, df[host].cast("string").alias("host"), df[path].cast("string").alias("path")
    )
    found = posteriors(scored.join(known, "key", "left"))
    return found.withColumn("kept", F.col("posterior") >= KEEP).withColumnRenamed("key", key)


def quality_filter(df: DataFrame, key: str, text: str, host: str, path: str, labels: DataFrame) -> DataFrame:
    """The rows of ``df`` that are kept. A row without a key stays, as no key names it; a key
    that several rows have stays if one of them is kept."""
    found = classify(df, key, text, host, path, labels)
    gone, rows = write_counted(
        found.groupBy(key).agg(F.max("kept").alias("kept")).filter("NOT kept").select(key), "quality-gone"
    )
    return without_keys(df, gone, key, rows)


def held_out(key: str) -> Column:
    """Rows whose labels are not learned from, to measure by."""
    return F.crc32(id_text(key).cast("binary")) % 4 == 2
