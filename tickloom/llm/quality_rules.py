"""Quality rules with robust multivariate outliers.

Each text gives a vector of transformed statistics. For every language and source a minimum
covariance determinant (MCD) estimate of centre and scatter is found by concentration steps, and
documents far from the centre by Mahalanobis distance are rejected.

A concentration step is one Spark aggregation over all groups at once: distances fall into fine
logarithmic bins, each bin keeps count, sums and cross products, and the nearest bins that
hold the wanted share of the group give the next estimate. So no group is ever in one task.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import arrays
from tickloom.llm.frames import map_texts, stored

MIN_WORDS, REPEAT_WORDS, MAX_REPEAT_PERCENT = 20, 8, 30

STATS = "n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, n_repeat_words BIGINT, n_upper BIGINT, n_chars_all BIGINT"

# The vector: name -> transformed statistic. Shares are taken as odds-like logarithms with an
# offset, so that a few symbols in a long text move it little.
FEATURES = ("length", "word_size", "symbols", "dup_lines", "repeats", "upper")

# Standard deviation that each feature has at least, in transformed units. Most groups have
# almost no spread in the last four features; without a floor any trace would be an outlier.
SPREAD_FLOOR = (0.5, 0.12, 0.25, 0.6, 0.8, 0.25)
SUPPORT = 0.75
STEPS = 5
MIN_GROUP = 60
BINS_PER_UNIT = 64
# Chi-square quantile of 1 - 1e-6 on six degrees of freedom, on the squared distance.
CUTOFF = 38.26

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _stats(data, bounds, rows):
    starts, ends, first = arrays.words(data, bounds, arrays.NOT_SPACE)
    word_row = arrays.owners(first)
    chars = np.concatenate([[0], np.cumsum(arrays.NOT_CONTINUED[data])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])

    head, tail, first_line = arrays.lines(data, bounds)
    filled = np.searchsorted(starts, tail) > np.searchsorted(starts, head)
    line_row = arrays.owners(first_line)
    keys = arrays.mix(arrays.byte_hash(data, head, tail) ^ (line_row.astype(np.uint64) * _SALT))[filled]
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), bool)
    later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    dup_lines = np.bincount(line_row[filled][later], minlength=len(bounds) - 1)

    at = arrays.window_starts(first, REPEAT_WORDS)
    hashes = arrays.byte_hash(data, starts, ends)
    windows = arrays.range_hash(hashes, at, at + REPEAT_WORDS)
    twice = at[arrays.repeated(arrays.mix(windows ^ (word_row[at].astype(np.uint64) * _SALT)))]
    flags = arrays.covered(twice, twice + REPEAT_WORDS, len(starts))
    return [
        np.diff(first),
        arrays.sums(chars[ends] - chars[starts], first),
        np.diff(symbols[bounds]),
        dup_lines,
        arrays.sums(flags, first),
        np.diff(upper[bounds]),
        np.diff(chars[bounds]),
    ]


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Struct ``row`` with the document's columns, struct ``result`` with the statistics of its whole text."""
    return map_texts(docs, text_col, STATS, lambda: _stats)


def base_failed(stats: str = "result"):
    words = F.col(f"{stats}.n_words")
    return (words < MIN_WORDS) | (100 * F.col(f"{stats}.n_repeat_words") > MAX_REPEAT_PERCENT * words)


def features(stats: str = "result") -> dict:
    col = lambda name: F.col(f"{stats}.{name}").cast("double")
    words = F.greatest(col("n_words"), F.lit(1.0))
    share = lambda part, whole: F.log(part / F.greatest(whole, F.lit(1.0)) + 0.02) - math.log(0.02)
    return {
        "length": F.log(col("n_words") + 1),
        "word_size": F.log(F.greatest(col("word_chars"), F.lit(1.0)) / words),
        "symbols": share(col("n_symbols"), col("n_chars_all")),
        "dup_lines": share(col("n_dup_lines"), words / 12),
        "repeats": share(col("n_repeat_words"), words),
        "upper": share(col("n_upper"), col("n_chars_all")),
    }


def _squared_distance(model: str = "model"):
    """|W (x - centre)|^2 with the whitening matrix in row order."""
    size = len(FEATURES)
    off = [F.col(f"x.{name}") - F.col(f"{model}.centre")[i] for i, name in enumerate(FEATURES)]
    whitened = [reduce(lambda a, b: a + b, (F.col(f"{model}.whiten")[r * size + c] * off[c] for c in range(r + 1))) for r in range(size)]
    return reduce(lambda a, b: a + b, (w * w for w in whitened))


def _moments():
    """Count, sums and cross products of the feature vectors."""
    x = [F.col(f"x.{name}") for name in FEATURES]
    firsts = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    seconds = [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(len(x)) for j in range(i + 1)]
    return [F.count("*").alias("n"), *firsts, *seconds]


MOMENTS = ["n", *(f"s{i}" for i in range(len(FEATURES))), *(f"q{i}_{j}" for i in range(len(FEATURES)) for j in range(i + 1))]


def _chi2_cdf_even(x: float, degrees: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(degrees // 2))


def consistency(support: float, degrees: int) -> float:
    """Factor that makes the scatter of the nearest share of normal data that of all."""
    low, high = 0.0, 200.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_cdf_even(middle, degrees) < support else (low, middle)
    return support / _chi2_cdf_even(low, degrees + 2)


def _models(moments: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Centre and whitening matrix (inverse Cholesky factor) of each row of moments; one row is one group."""
    size, floor = len(FEATURES), np.diag(np.square(SPREAD_FLOOR))
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]

    def fit(batches):
        for table in batches:
            values = table[MOMENTS].to_numpy(float)
            n = values[:, 0]
            centre = values[:, 1 : size + 1] / n[:, None]
            scatter = np.zeros((len(values), size, size))
            for k, (i, j) in enumerate(pairs):
                cell = values[:, size + 1 + k] / n - centre[:, i] * centre[:, j]
                scatter[:, i, j] = scatter[:, j, i] = cell
            low, vectors = np.linalg.eigh(scatter * factor)
            scatter = (vectors * np.maximum(low, 0)[:, None, :]) @ np.swapaxes(vectors, 1, 2)
            whiten = np.linalg.inv(np.linalg.cholesky(scatter + floor))
            yield pd.DataFrame({k: table[k] for k in keys} | {"centre": list(centre), "whiten": list(whiten.reshape(len(values), -1))})

    kinds = {name: kind for name, kind in moments.dtypes}
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", centre ARRAY<DOUBLE>, whiten ARRAY<DOUBLE>"
    return moments.mapInPandas(fit, schema)


def _marginal_start(points: DataFrame) -> DataFrame:
    """group, n_group, centre (medians) and whiten (from quartile ranges), of features in steps of 1 / BINS_PER_UNIT."""
    listed = F.array(*[F.floor(F.col(f"x.{name}") * BINS_PER_UNIT).alias(name) for name in FEATURES])
    bins = points.select("group", F.posexplode(listed).alias("feature", "bin")).groupBy("group", "feature", "bin").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("group", "feature")
    upto = F.sum("n").over(whole.orderBy("bin"))
    ranked = bins.withColumn("upto", upto).withColumn("n_group", F.sum("n").over(whole))
    quantile = lambda share: F.min(F.when(F.col("upto") >= share * F.col("n_group"), F.col("bin"))) / BINS_PER_UNIT
    by_feature = ranked.groupBy("group", "feature").agg(
        F.max("n_group").alias("n_group"), quantile(0.5).alias("middle"), ((quantile(0.75) - quantile(0.25)) / 1.349).alias("spread")
    )
    floor = F.array(*[F.lit(f) for f in SPREAD_FLOOR])
    scale = 1 / F.sqrt(F.col("spread") * F.col("spread") + floor[F.col("feature")] * floor[F.col("feature")])
    size = len(FEATURES)
    return (
        by_feature.groupBy("group")
        .agg(F.max("n_group").alias("n_group"), F.sort_array(F.collect_list(F.struct("feature", "middle", scale.alias("scale")))).alias("m"))
        .select(
            "group",
            "n_group",
            F.col("m.middle").alias("centre"),
            F.array(*[F.col("m.scale")[r] if r == c else F.lit(0.0) for r in range(size) for c in range(size)]).alias("whiten"),
        )
    )


def fit_mcd(points: DataFrame, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """MCD estimate of each value of ``group`` in ``points(group, x)``: one row (group, n_group, centre, whiten).

    The start is the median and the quartile range of each feature by itself, which a minority of outliers
    cannot move far; each step keeps the nearest ``support`` of the group. A diagonal floor keeps
    the scatter regular when most of the group lies in a plane.
    """
    models = stored(_marginal_start(points), "mcd")
    nearest = Window.partitionBy("group").orderBy("bin")
    for step in range(steps):
        distance = F.log2(_squared_distance() + 1e-9)
        binned = (
            points.join(models.select("group", "n_group", F.struct("centre", "whiten").alias("model")), "group")
            .withColumn("bin", F.floor(distance * BINS_PER_UNIT))
            .groupBy("group", "bin")
            .agg(F.first("n_group").alias("n_group"), *_moments())
        )
        # At most a few thousand bins in a group, whatever its size.
        inner = binned.withColumn("before", F.coalesce(F.sum("n").over(nearest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        kept = inner.where(F.col("before") < support * F.col("n_group"))
        total = kept.groupBy("group").agg(F.first("n_group").alias("n_group"), *(F.sum(m).alias(m) for m in MOMENTS))
        fitted = _models(total, ["group", "n_group"], consistency(support, len(FEATURES)))
        models = stored(fitted, "mcd")
    return models


def outliers(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = MIN_GROUP,
    cutoff: float = CUTOFF,
) -> DataFrame:
    """Statistics, base rule and MCD verdict of every document.

    Returns ``row`` (the document's columns), ``result`` (statistics), ``base_failed``,
    ``distance`` (squared Mahalanobis distance) and ``kept``. The estimates use all documents that
    pass the base rule. A (language, source) group of fewer than ``min_group`` such documents is judged
    by its language, a smaller language by all documents; with fewer than ``min_group`` in all,
    nothing is rejected but by the base rule. Null languages and sources are groups of their own. Null
    and empty texts fail the base rule. Repeated rows count as often as they occur.
    """
    x = F.struct(*[v.alias(k) for k, v in features().items()])
    lang, source = F.col(f"row.`{lang_col}`").cast("string"), F.col(f"row.`{source_col}`").cast("string")
    levels = [F.to_json(F.struct(*parts)) for parts in ([lang.alias("l"), source.alias("s"), F.lit(2).alias("n")], [lang.alias("l"), F.lit(1).alias("n")], [F.lit(0).alias("n")])]
    measured = stored(
        statistics(docs, text_col).select("row", "result", base_failed().alias("base_failed"), x.alias("x"), F.array(*levels).alias("groups")),
        "statistics",
    )
    points = measured.where(~F.col("base_failed")).select(F.explode("groups").alias("group"), "x")
    models = fit_mcd(points).where(F.col("n_group") >= min_group).select("group", F.struct("centre", "whiten").alias("model"))
    judged = measured
    for level in range(3):
        judged = judged.join(
            models.select(F.col("group").alias(f"g{level}"), F.col("model").alias(f"m{level}")),
            F.col("groups")[level] == F.col(f"g{level}"),
            "left",
        )
    judged = judged.withColumn("model", F.coalesce("m0", "m1", "m2")).withColumn("distance", _squared_distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select("row", "result", "base_failed", "distance", kept.alias("kept"))
