"""Distribution drift of every feature between a reference and a current frame."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetgauge.functions.ordering import running

# Significance of the tests, cut-off of the distances.
P_VALUE = 0.05
DISTANCE = 0.1
_SERIES_TERMS = 50
_GAMMA_TERMS = 300


def _tall(df: DataFrame, features: Sequence[str], side: str, groups: Sequence[str]) -> DataFrame:
    """Distinct values per feature with counts: the union below is already reduced."""
    numbers = df.select(*groups, *[F.col(c).cast("double").alias(c) for c in features])
    tall = numbers.unpivot(list(groups), list(features), "feature", "value")
    is_ref = side == "reference"
    return (
        tall.where(F.col("value").isNotNull())
        .groupBy(*groups, "feature", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *groups, "feature", "value",
            (F.col("_n") if is_ref else F.lit(0).cast("bigint")).alias("n_ref"),
            (F.lit(0).cast("bigint") if is_ref else F.col("_n")).alias("n_cur"),
        )
    )


def drift_distances(
    reference: DataFrame, current: DataFrame, features: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Per feature: row counts, largest gap between the two distribution functions, and area
    between them divided by the reference's population deviation. One job for all features."""
    keys = [*groups, "feature"]
    values = (
        _tall(reference, features, "reference", groups)
        .unionByName(_tall(current, features, "current", groups))
        .groupBy(*keys, "value")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    placed = running(
        values, keys, "value", {"_ref": "n_ref", "_cur": "n_cur"},
        {"_all_ref": "_ref", "_all_cur": "_cur"}, following="_next",
    )
    gap = F.abs(
        F.try_divide(F.col("_ref"), F.col("_all_ref")) - F.try_divide(F.col("_cur"), F.col("_all_cur"))
    )
    step = F.coalesce(F.col("_next") - F.col("value"), F.lit(0.0))
    distances = placed.groupBy(*keys).agg(
        F.max("_all_ref").alias("n_reference"),
        F.max("_all_cur").alias("n_current"),
        F.max(gap).alias("ks"),
        F.sum(gap * step).alias("_area"),
    )
    return distances.join(reference_scale(reference, features, groups), keys).select(
        *keys, "n_reference", "n_current", "ks",
        (F.col("_area") / F.nullif(F.col("reference_std"), F.lit(0.0))).alias("wasserstein"),
    )


def reference_scale(
    reference: DataFrame, features: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Population deviation of every reference feature, one pass over the rows."""
    spread = reference.groupBy(*groups).agg(
        *[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in features]
    )
    return spread.unpivot(list(groups), list(features), "feature", "reference_std")


def ks_p_value(ks, n_ref, n_cur):
    """Asymptotic two-sided p-value of the two-sample rank test."""
    size = n_ref.cast("double") * n_cur / (n_ref + n_cur)
    lam = ks * F.sqrt(size)
    total = F.lit(0.0)
    for k in range(1, _SERIES_TERMS + 1):
        total = total + (1.0 if k % 2 else -1.0) * F.exp(-2.0 * k * k * lam * lam)
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * total)))


def drift_report(
    reference: DataFrame, current: DataFrame, features: Sequence[str], groups: Sequence[str] = (),
    *, method: str, p_value: float = P_VALUE, distance: float = DISTANCE,
) -> DataFrame:
    """Drift flag per feature by the rank test (`ks`) or the area between the distributions
    (`wasserstein`), at any size of the input."""
    if method not in ("ks", "wasserstein"):
        raise ValueError("method must be ks or wasserstein")
    found = drift_distances(reference, current, features, groups)
    use_ks = F.lit(method == "ks")
    p = ks_p_value(F.col("ks"), F.col("n_reference"), F.col("n_current"))
    drifted = F.when(use_ks, p < p_value).otherwise(F.col("wasserstein") >= distance)
    return found.withColumns(
        {
            "method": F.when(use_ks, "ks").otherwise("wasserstein"),
            "p_value": p,
            "drifted": F.coalesce(drifted, F.lit(False)),
        }
    )


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function for a > 0: Stirling's series after eight steps up."""
    z, shift = a + 8.0, F.lit(0.0)
    for k in range(8):
        shift = shift + F.log(a + float(k))
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - shift


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x), a > 0, x >= 0: the power series below
    a + 1, the continued fraction above, each of a fixed number of terms."""
    steps = F.sequence(F.lit(1), F.lit(_GAMMA_TERMS))
    front = F.exp(a * F.log(x) - x - log_gamma(a))
    start = F.struct((1 / a).alias("term"), (1 / a).alias("total"))
    power = F.aggregate(steps, start, lambda s, k: F.struct(
        (s["term"] * x / (a + k)).alias("term"), (s["total"] + s["term"] * x / (a + k)).alias("total")))["total"]
    tiny, b = 1e-300, x + 1 - a

    def level(s: Column, k: Column) -> Column:
        factor, at = -k * (k - a), b + 2 * k
        d = 1 / F.when(F.abs(at + factor * s["d"]) < tiny, F.lit(tiny)).otherwise(at + factor * s["d"])
        c = at + factor / s["c"]
        c = F.when(F.abs(c) < tiny, F.lit(tiny)).otherwise(c)
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    first = F.struct(F.lit(1 / tiny).alias("c"), (1 / b).alias("d"), (1 / b).alias("h"))
    fraction = F.aggregate(steps, first, level)["h"]
    value = F.when(x <= 0, F.lit(1.0)).when(x < a + 1, 1 - front * power).otherwise(front * fraction)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def category_counts(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Contingency tables of all columns in one shuffle: `feature, category, n_ref, n_cur` per group.
    Missing categories are left out; a category of either side has a row."""
    sides = []
    for df, here in ((reference, "n_ref"), (current, "n_cur")):
        texts = df.select(*groups, *[F.col(c).cast("string").alias(c) for c in columns])
        tall = texts.unpivot(list(groups), list(columns), "feature", "category").where("category IS NOT NULL")
        one = {n: F.lit(1 if n == here else 0).cast("bigint") for n in ("n_ref", "n_cur")}
        sides.append(tall.withColumns(one))
    return sides[0].unionByName(sides[1]).groupBy(*groups, "feature", "category").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )


def category_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], groups: Sequence[str] = (),
    *, method: str, p_value: float = P_VALUE, distance: float = DISTANCE,
) -> DataFrame:
    """Drift of categorical columns: `chi_square` with its `p_value` (independence of side and category),
    and `jensen_shannon`, the square root of the divergence in bits. `method` names the one that decides
    `drifted`, at any size. A feature that one side lacks has no figures and isn't drifted."""
    if method not in ("chi_square", "jensen_shannon"):
        raise ValueError("method must be chi_square or jensen_shannon")
    keys = [*groups, "feature"]
    counts = category_counts(reference, current, columns, groups)
    sizes = counts.groupBy(*keys).agg(
        F.sum("n_ref").alias("n_reference"), F.sum("n_cur").alias("n_current"), F.count(F.lit(1)).alias("categories")
    )
    rows = counts.join(sizes, keys)
    total = (F.col("n_reference") + F.col("n_current")).cast("double")
    both = F.col("n_ref") + F.col("n_cur")
    squares, bits = F.lit(0.0), F.lit(0.0)
    for n, size in (("n_ref", "n_reference"), ("n_cur", "n_current")):
        expected = F.col(size) * both / total
        squares = squares + F.try_divide((F.col(n) - expected) * (F.col(n) - expected), expected)
    p, q = (F.try_divide(F.col(n).cast("double"), F.col(s)) for n, s in (("n_ref", "n_reference"), ("n_cur", "n_current")))
    middle = (p + q) / 2
    for share in (p, q):
        bits = bits + F.when(share > 0, share * F.log2(share / middle) / 2).otherwise(F.when(share == 0, F.lit(0.0)))
    found = rows.groupBy(*keys, "n_reference", "n_current", "categories").agg(
        F.sum(squares).alias("chi_square"), F.sqrt(F.greatest(F.lit(0.0), F.sum(bits))).alias("jensen_shannon")
    )
    freedom = (F.col("categories") - 1).cast("double")
    tail = F.when(freedom == 0, F.lit(1.0)).otherwise(upper_gamma(freedom / 2, F.col("chi_square") / 2))
    known = (F.col("n_reference") > 0) & (F.col("n_current") > 0)
    found = found.withColumns({c: F.when(known, F.col(c)) for c in ("chi_square", "jensen_shannon")})
    found = found.withColumn("p_value", F.when(known, tail))
    decided = F.col("p_value") < p_value if method == "chi_square" else F.col("jensen_shannon") >= distance
    return found.withColumns({"method": F.lit(method), "drifted": F.coalesce(decided, F.lit(False))})


def drift_summary(report: DataFrame) -> DataFrame:
    """Totals, share and sorted names of drifted features."""
    flag = F.col("drifted")
    return report.agg(
        F.count(F.lit(1)).alias("total_features"),
        F.coalesce(F.sum(flag.cast("bigint")), F.lit(0)).alias("drifted_features"),
        F.bround(F.coalesce(F.avg(flag.cast("double")), F.lit(0.0)), 4).alias("drift_share"),
        F.array_sort(F.collect_list(F.when(flag, F.col("feature")))).alias("drifted_columns"),
    )
