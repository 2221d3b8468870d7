"""Maintenance decisions: alerts, cost-optimal actions and threshold trade-offs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetgauge.functions.ordering import histogram, running, weighted_quantiles
from fleetgauge.functions.scalars import clip, fixed0, linspace
from fleetgauge.schema import RISK_THRESHOLD, CostPolicy

# Urgency cut-offs and the default sweep.
CRITICAL_RISK = 0.8
CRITICAL_RUL = 10
SCHEDULED_RISK = 0.3
CYCLES_PER_DAY = 3.0
SWEEP = linspace(0.1, 0.9, 17)


def action_costs(risk: Column, policy: CostPolicy) -> dict[str, Column]:
    """Expected cost of each action at a risk clipped to [0, 1]."""
    r = clip(risk, 0.0, 1.0)
    return {
        "replace": F.when(r.isNotNull(), F.lit(policy.replacement)),
        "inspect": F.lit(policy.inspection) + r * policy.replacement
        + (1.0 - r) * policy.false_alarm,
        "continue": r * policy.unplanned_failure,
    }


def cheapest(costs: dict[str, Column]) -> tuple[Column, Column]:
    """Name and cost of the cheapest action; the earlier one wins a tie."""
    least = F.least(*costs.values())
    chosen = F.coalesce(*[F.when(cost == least, F.lit(name)) for name, cost in costs.items()])
    return chosen, least


def add_actions(df: DataFrame, risk: str = "risk", policy: CostPolicy = CostPolicy()) -> DataFrame:
    costs = action_costs(F.col(risk).cast("double"), policy)
    action, cost = cheapest(costs)
    named = {f"cost_{name}": column for name, column in costs.items()}
    return df.withColumns({**named, "action": action, "expected_cost": cost})


def alerts(
    df: DataFrame,
    risk: str = "risk",
    rul: str = "predicted_rul",
    threshold: float = RISK_THRESHOLD,
    cycles_per_day: float = CYCLES_PER_DAY,
    reference_date: dt.date | None = None,
    policy: CostPolicy = CostPolicy(),
    keep: Sequence[str] = ("variant", "unit_id"),
) -> DataFrame:
    """One service alert per scored row, all in one projection; without a risk the urgency is
    `unknown`, unless the remaining life alone makes it critical."""
    start = F.lit(reference_date) if reference_date else F.current_date()
    r = F.nullif(F.col(risk).cast("double"), F.lit(float("nan")))  # NaN would exceed every threshold
    left = clip(F.col(rul).cast("double"), 0.0)
    days = F.ceil(left / F.lit(max(cycles_per_day, 1e-9))).cast("int")
    base = df.select(*keep, r.alias("_risk"), left.alias("_rul"), days.alias("days_until_service"))
    base = base.withColumn("_date", F.date_add(start, F.col("days_until_service")))
    r, left = F.col("_risk"), F.col("_rul")
    urgency = (
        F.when((r >= CRITICAL_RISK) | (left <= CRITICAL_RUL), "critical")
        .when(r >= threshold, "high")
        .when(r >= SCHEDULED_RISK, "scheduled")
        .when(r.isNull(), "unknown")
        .otherwise("ok")
    )
    unit, day_text = F.col("unit_id").cast("string"), F.col("days_until_service").cast("string")
    iso = F.date_format(F.col("_date"), "yyyy-MM-dd")

    def text(head: str, tail: str) -> Column:
        return F.concat(
            F.lit("Unit "), unit, F.lit(head), F.lit(" Estimated RUL "), fixed0(left),
            F.lit(" cycles ("), day_text, F.lit(" days). " + tail + " "), iso, F.lit("."),
        )

    # Message texts per urgency.
    message = (
        F.when(
            F.col("urgency") == "critical",
            text(": CRITICAL — immediate inspection required.", "Recommend service by"),
        )
        .when(
            F.col("urgency") == "high",
            text(": HIGH RISK — schedule maintenance soon.", "Recommended service date:"),
        )
        .when(
            F.col("urgency") == "scheduled",
            text(": EARLY WARNING — plan service within schedule.", "Next service window:"),
        )
        .when(F.col("urgency") == "unknown", F.concat(F.lit("Unit "), unit, F.lit(": no risk score available.")))
        .otherwise(
            F.concat(F.lit("Unit "), unit, F.lit(": operating normally. Next check in "), day_text,
                     F.lit(" days."))
        )
    )
    action, cost = cheapest(action_costs(r, policy))
    return base.withColumn("urgency", urgency).select(
        *keep,
        F.bround(r, 4).alias("risk_score"),
        F.bround(left, 1).alias("estimated_rul_cycles"),
        "urgency",
        iso.alias("recommended_service_date"),
        "days_until_service",
        message.alias("message"),
        action.alias("action"),
        F.bround(cost, 2).alias("expected_cost"),
    )


def sweep(
    df: DataFrame,
    groups: Sequence[str] = (),
    y: str = "label_within_x",
    score: str = "risk",
    rul: str = "rul",
    thresholds: Sequence[float] = tuple(SWEEP),
    policy: CostPolicy | None = None,
    cost_by_threshold: bool = False,
) -> DataFrame:
    """Operational counts and lead times at every threshold.

    Each row is reduced to the number of thresholds its score reaches, so the data is read and
    aggregated once and the thresholds meet only the pre-aggregated counts. With a policy,
    `expected_cost` is the mean of each row's cheapest action and so the same at every
    threshold; `cost_by_threshold` instead charges flagged rows the cheaper of replacing and
    inspecting, and the others the cost of carrying on.
    """
    keys = list(groups)
    s, t = F.col(score).cast("double"), sorted(thresholds)
    reached = F.lit(0)
    for value in t:
        reached = reached + (s >= F.lit(value)).cast("int")
    positive = F.col(y) == 1
    costs = action_costs(s, policy or CostPolicy())
    rows = df.select(
        *groups,
        reached.alias("_reached"),
        positive.cast("bigint").alias("_pos"),
        F.when(positive, F.col(rul).cast("double")).alias("_lead"),
        cheapest(costs)[1].alias("_best"),
        F.least(costs["replace"], costs["inspect"]).alias("_service"),
        costs["continue"].alias("_carry"),
    )
    steps = F.array(*[
        F.struct(F.lit(i + 1).alias("_step"), F.lit(v).alias("_t")) for i, v in enumerate(t)
    ])
    levels = rows.groupBy(*keys, "_reached").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_pos").alias("pos"),
        F.sum("_lead").alias("lead"),
        F.sum("_best").alias("best"),
        F.sum("_service").alias("service"),
        F.sum("_carry").alias("carry"),
    )
    flagged = F.col("_reached") >= F.col("_step")

    def total(value: Column, when: Column) -> Column:
        return F.sum(F.when(when, value).otherwise(0))

    tp = total(F.col("pos"), flagged)
    by_step = (
        levels.select(*keys, "_reached", "n", "pos", "lead", "best", "service", "carry",
                      F.inline(steps))
        .groupBy(*keys, "_step", "_t")
        .agg(
            total(F.col("n"), flagged).alias("alerts"),
            total(F.col("pos"), ~flagged).alias("missed_failures"),
            tp.alias("prevented_failures"),
            total(F.col("n") - F.col("pos"), flagged).alias("false_service_calls"),
            (F.sum(F.when(flagged, F.col("lead"))) / F.nullif(tp, F.lit(0))).alias("_mean"),
            (F.sum("best") / F.sum("n")).alias("_cost"),
            (F.sum(F.when(flagged, F.col("service")).otherwise(F.col("carry"))) / F.sum("n"))
            .alias("_cost_at"),
        )
    )
    leads = (
        histogram(rows, [*keys, "_reached"], "_lead")
        .where(F.col("_reached") >= 1)
        .withColumn("_step", F.explode(F.sequence(F.lit(1), F.col("_reached"))))
        .groupBy(*keys, "_step", "_lead")
        .agg(F.sum("n").alias("n"))
    )
    medians = weighted_quantiles(leads, [*keys, "_step"], "_lead", {"_median": 0.5}).drop("n")
    cost = F.col("_cost_at") if cost_by_threshold else F.col("_cost")
    return by_step.join(medians, [*keys, "_step"], "left").select(
        *groups,
        F.bround("_t", 3).alias("threshold"),
        "alerts",
        "missed_failures",
        "prevented_failures",
        "false_service_calls",
        F.bround(F.coalesce("_mean", F.lit(0.0)), 2).alias("mean_lead_time_cycles"),
        F.bround(F.coalesce("_median", F.lit(0.0)), 2).alias("median_lead_time_cycles"),
        *([F.bround(cost, 2).alias("expected_cost")] if policy else []),
    )


def cheapest_threshold(table: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """First threshold with the lowest expected cost."""
    order = F.struct(F.col("expected_cost"), F.col("threshold"))
    return table.groupBy(*groups).agg(
        F.min_by("threshold", order).alias("threshold"),
        F.min("expected_cost").alias("expected_cost"),
    )


# One output row per prevented failure: counts are expanded in pieces of this size.
_EXPAND = 10_000


def _lead_counts(df, groups, y, score, rul, threshold) -> DataFrame:
    hits = df.where((F.col(score) >= threshold) & (F.col(y) == 1)).select(
        *groups, F.col(rul).cast("double").alias("lead_time_cycles")
    )
    hist = histogram(hits, groups, "lead_time_cycles")
    return running(hist, groups, "lead_time_cycles", {"_upto": "n"}, {"_size": "_upto"})


def lead_time_cdf(
    df: DataFrame,
    groups: Sequence[str] = (),
    y: str = "label_within_x",
    score: str = "risk",
    rul: str = "rul",
    threshold: float = RISK_THRESHOLD,
) -> DataFrame:
    """Lead times of flagged failures with i/n, one row each, equal values kept apart.

    Places come from running counts per distinct value; a frequent value is expanded in
    pieces that are spread over tasks.
    """
    counts = _lead_counts(df, groups, y, score, rul, threshold)
    first = F.col("_upto") - F.col("n") + 1
    pieces = counts.withColumn("_from", F.explode(F.sequence(first, F.col("_upto"), F.lit(_EXPAND).cast("bigint"))))
    spread = pieces.repartition("lead_time_cycles", "_from")
    last = F.least(F.col("_upto"), F.col("_from") + (_EXPAND - 1))
    return spread.withColumn("_place", F.explode(F.sequence("_from", last))).select(
        *groups, "lead_time_cycles", (F.col("_place") / F.col("_size")).alias("cdf")
    )


def median_lead_time(
    df: DataFrame,
    groups: Sequence[str] = (),
    y: str = "label_within_x",
    score: str = "risk",
    rul: str = "rul",
    threshold: float = RISK_THRESHOLD,
) -> DataFrame:
    """Smallest lead time whose CDF reaches one half."""
    counts = _lead_counts(df, groups, y, score, rul, threshold)
    return (
        counts.where(F.col("_upto") / F.col("_size") >= 0.5)
        .groupBy(*groups)
        .agg(F.min("lead_time_cycles").alias("median_lead_time"))
    )
