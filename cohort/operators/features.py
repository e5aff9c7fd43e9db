"""The built-in features.

Row-wise features are plain expressions over the input columns and need no
shuffle.  Income statistics are a handful of numbers fitted once; the three
imputations join a fitted table of group modes.  Both kinds are deferred, so that the
registry gathers their statistics together.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort.functions.values import (
    INFINITY,
    band,
    holds,
    log1p,
    nan_to_null,
    or_zero,
    quantile_bin,
    quoted,
    ratio,
    square_root,
    to_number,
)
from cohort.operators.groups import GroupFill
from cohort.operators.numbers import summarize_numbers
from cohort.operators.statistics import Deferred, NumberStats, NumberSummary
from cohort.plans.registry import FeatureRegistry

REGISTRY = FeatureRegistry()

REGISTRY.storable(GroupFill)

# Band edges and labels.
INCOME_EDGES = (-INFINITY, 25_000, 50_000, 75_000, 100_000, 150_000, INFINITY)
INCOME_LABELS = ("<25k", "25–50k", "50–75k", "75–100k", "100–150k", "150k+")
SMOKE_EDGES = (0, 1, 5, 10, 20, INFINITY)
SMOKE_LABELS = ("none", "ultra", "light", "med", "heavy")
DRINK_EDGES = (0, 1, 7, 14, 28, INFINITY)
DRINK_LABELS = ("none", "very_low", "low", "mod", "high")

# Thresholds.
HEAVY_SMOKES_PER_DAY = 20
HEAVY_DRINKS_PER_WEEK = 14
ELEVATED_RISK_COUNT = 2
DECILES = tuple(i / 10 for i in range(11))

PII_COLUMNS = ("id", "name")


def number(df: DataFrame, name: str) -> Column:
    return to_number(quoted(name), df.schema[name].dataType)


def drop_target_columns(df: DataFrame, target: str | None) -> DataFrame:
    """Without the target and every column named after it (``target_*``)."""
    if not target:
        return df
    return df.drop(*[c for c in df.columns if c == target or c.startswith(f"{target}_")])


# --- row-wise expressions, usable on their own -------------------------------


def income_band(income: Column, *, include_lowest: bool = True) -> Column:
    return band(income, INCOME_EDGES, INCOME_LABELS, include_lowest=include_lowest)


def smoke_band(per_day: Column, *, include_lowest: bool = True) -> Column:
    return band(per_day, SMOKE_EDGES, SMOKE_LABELS, include_lowest=include_lowest)


def drink_band(per_week: Column, *, include_lowest: bool = True) -> Column:
    return band(per_week, DRINK_EDGES, DRINK_LABELS, include_lowest=include_lowest)


def dependents_ratio(children: Column, income: Column, *, fill_missing: bool = True) -> Column:
    if fill_missing:
        children, income = or_zero(children), or_zero(income)
    return ratio(children + 1, income + 1)


def quit_effort(attempts: Column, amount: Column, *, fill_missing: bool = True) -> Column:
    if fill_missing:
        attempts, amount = or_zero(attempts), or_zero(amount)
    return ratio(attempts, amount + 1)


def risk_count(predicates: Iterable[Column]) -> Column:
    total = F.lit(0)
    for p in predicates:
        total = total + holds(p).cast("int")
    return total


# --- registered features -----------------------------------------------------


@REGISTRY.feature("basic_cleanup", order=0, desc="Drop the identifying columns id and name.")
def drop_pii(df: DataFrame) -> DataFrame:
    return df.drop(*PII_COLUMNS)


def income_levels(df: DataFrame) -> DataFrame:
    """Band and log of income: row-wise, nothing is fitted."""
    income = number(df, "annual_income_usd")
    return df.withColumns({"income_band": income_band(income), "log_income": log1p(income)})


@dataclass(frozen=True)
class IncomeScore:
    """z-score of income for a fitted mean and deviation, from one pass."""

    mean: float | None
    std: float

    @classmethod
    def fit(cls, df: DataFrame) -> IncomeScore:
        column = "annual_income_usd"
        return cls.of(summarize_numbers(df, [column])[column])

    @classmethod
    def of(cls, found: NumberSummary) -> IncomeScore:
        std = found.std_samp
        return cls(found.mean, std if std is not None and 0 < std < INFINITY else 1.0)

    def transform(self, df: DataFrame) -> DataFrame:
        centred = number(df, "annual_income_usd") - F.lit(self.mean).cast("double")
        return df.withColumn("income_z", nan_to_null(centred / self.std))


@REGISTRY.storable
@dataclass(frozen=True)
class IncomeFeatures:
    """Band, log, z-score and decile of income for fitted statistics."""

    score: IncomeScore
    edges: tuple[float | None, ...]

    @classmethod
    def deferred(cls, **quantile_options) -> Deferred:
        """Band and log come early, as they need no statistics."""
        column = "annual_income_usd"
        request = NumberStats([column], DECILES, **quantile_options)

        def build() -> IncomeFeatures:
            found = request.summaries[column]
            return cls(IncomeScore.of(found), tuple(found.quantiles[p] for p in DECILES))

        return Deferred([request], build, early=income_levels)

    @classmethod
    def fit(cls, df: DataFrame, **quantile_options) -> IncomeFeatures:
        return cls.deferred(**quantile_options).now(df)

    def stored(self) -> tuple[dict[str, Any], dict[str, DataFrame]]:
        """What ``restored`` makes the same features of."""
        return {"mean": self.score.mean, "std": self.score.std, "edges": list(self.edges)}, {}

    @classmethod
    def restored(cls, plain: dict[str, Any], tables: dict[str, DataFrame]) -> IncomeFeatures:
        return cls(IncomeScore(plain["mean"], plain["std"]), tuple(plain["edges"]))

    def transform(self, df: DataFrame) -> DataFrame:
        income = number(df, "annual_income_usd")
        out = self.score.transform(income_levels(df))
        return out.withColumn("income_decile", quantile_bin(income, self.edges))


@REGISTRY.feature(
    "income_features",
    requires=["annual_income_usd"],
    produces=["income_band", "log_income", "income_z", "income_decile"],
    order=10,
    desc="Band, log, z-score and decile of annual income.",
)
def income_features(df: DataFrame) -> Deferred:
    return IncomeFeatures.deferred()


@REGISTRY.feature(
    "smoke_intensity",
    requires=["smokes_per_day"],
    produces=["smoke_intensity"],
    order=20,
    desc="Smoking intensity band.",
)
def smoke_intensity(df: DataFrame) -> dict[str, Column]:
    return {"smoke_intensity": smoke_band(number(df, "smokes_per_day"))}


@REGISTRY.feature(
    "drink_intensity",
    requires=["drinks_per_week"],
    produces=["drink_intensity"],
    order=20,
    desc="Drinking intensity band.",
)
def drink_intensity(df: DataFrame) -> dict[str, Column]:
    return {"drink_intensity": drink_band(number(df, "drinks_per_week"))}


@REGISTRY.feature(
    "ratios_dependents",
    requires=["children_count", "annual_income_usd"],
    produces=["dependents_ratio"],
    order=30,
    desc="Household size against income.",
)
def ratios_dependents(df: DataFrame) -> dict[str, Column]:
    children, income = number(df, "children_count"), number(df, "annual_income_usd")
    return {"dependents_ratio": dependents_ratio(children, income)}


@REGISTRY.feature(
    "quit_effort_smoke_norm",
    requires=["attempts_to_quit_smoking", "smokes_per_day"],
    produces=["quit_effort_smoke_norm"],
    order=30,
    desc="Attempts to quit smoking against consumption.",
)
def quit_effort_smoke(df: DataFrame) -> dict[str, Column]:
    attempts, amount = number(df, "attempts_to_quit_smoking"), number(df, "smokes_per_day")
    return {"quit_effort_smoke_norm": quit_effort(attempts, amount)}


@REGISTRY.feature(
    "quit_effort_drink_norm",
    requires=["attempts_to_quit_drinking", "drinks_per_week"],
    produces=["quit_effort_drink_norm"],
    order=30,
    desc="Attempts to quit drinking against consumption.",
)
def quit_effort_drink(df: DataFrame) -> dict[str, Column]:
    attempts, amount = number(df, "attempts_to_quit_drinking"), number(df, "drinks_per_week")
    return {"quit_effort_drink_norm": quit_effort(attempts, amount)}


@REGISTRY.feature(
    "impute_social_support",
    requires=["social_support", "marital_status", "children_count"],
    produces=["social_support"],
    order=40,
    desc="Fill social support with the mode of its group.",
)
def impute_social_support(df: DataFrame) -> Deferred:
    return GroupFill.deferred("social_support", ["marital_status", "children_count"])


@REGISTRY.feature(
    "impute_education_level",
    requires=["education_level", "employment_status", "income_band"],
    produces=["education_level"],
    order=40,
    desc="Fill education with the mode of its group.",
)
def impute_education_level(df: DataFrame) -> Deferred:
    return GroupFill.deferred("education_level", ["employment_status", "income_band"])


@REGISTRY.feature(
    "impute_therapy_history",
    requires=["therapy_history", "education_level", "marital_status", "mental_health_status"],
    produces=["therapy_history"],
    order=40,
    desc="Fill therapy history with the mode of its group.",
)
def impute_therapy_history(df: DataFrame) -> Deferred:
    return GroupFill.deferred("therapy_history", ["education_level", "marital_status", "mental_health_status"])


@REGISTRY.feature(
    "heavy_poly_use",
    requires=["smokes_per_day", "drinks_per_week"],
    produces=["heavy_poly_use"],
    order=65,
    desc="Heavy smoker and heavy drinker at once.",
)
def heavy_poly_use(df: DataFrame) -> dict[str, Column]:
    smokes = number(df, "smokes_per_day") >= HEAVY_SMOKES_PER_DAY
    drinks = number(df, "drinks_per_week") >= HEAVY_DRINKS_PER_WEEK
    return {"heavy_poly_use": holds(smokes & drinks).cast("int")}


@REGISTRY.feature(
    "pack_years_transforms",
    requires=["pack_years"],
    produces=["pack_years_log", "pack_years_sqrt", "pack_years_sq"],
    order=66,
    desc="Log, square root and square of pack-years.",
)
def pack_years_transforms(df: DataFrame) -> dict[str, Column]:
    x = number(df, "pack_years")
    return {
        "pack_years_log": log1p(x),
        "pack_years_sqrt": square_root(x),
        "pack_years_sq": x * x,
    }


@REGISTRY.feature(
    "alcohol_transforms",
    requires=["drinks_per_week"],
    produces=["drink_per_day", "drink_per_day_sq", "drinks_per_week_log"],
    order=67,
    desc="Daily drinks, their square, log of weekly drinks.",
)
def alcohol_transforms(df: DataFrame) -> dict[str, Column]:
    weekly = number(df, "drinks_per_week")
    daily = weekly / 7.0
    return {
        "drink_per_day": daily,
        "drink_per_day_sq": daily * daily,
        "drinks_per_week_log": log1p(weekly),
    }


@REGISTRY.feature(
    "risk_burden",
    requires=[
        "heavy_smoker_flag", "heavy_drinker_flag", "bmi_obese_flag", "sleep_deficit",
        "diet_score", "exercise_score", "mh_score", "poly_use",
    ],
    produces=["risk_factor_count", "elevated_risk_flag"],
    order=68,
    desc="Number of lifestyle risks, and whether there are several.",
)
def risk_burden(df: DataFrame) -> dict[str, Column]:
    count = risk_count(
        [
            number(df, "heavy_smoker_flag") > 0,
            number(df, "heavy_drinker_flag") > 0,
            number(df, "bmi_obese_flag") > 0,
            number(df, "sleep_deficit") > 1,
            number(df, "diet_score") <= 1,
            number(df, "exercise_score") <= 1,
            number(df, "mh_score") >= 1,
            number(df, "poly_use") > 0,
        ]
    )
    return {
        "risk_factor_count": count,
        "elevated_risk_flag": (count >= ELEVATED_RISK_COUNT).cast("int"),
    }


@REGISTRY.feature(
    "duration_intensity_interactions",
    requires=["years_smoking", "smokes_per_day", "heavy_smoker_flag"],
    produces=["years_smoking_x_heavy", "years_smoking_x_spd"],
    order=70,
    desc="Years of smoking times intensity.",
)
def duration_intensity(df: DataFrame) -> dict[str, Column]:
    years = number(df, "years_smoking")
    heavy = holds(number(df, "heavy_smoker_flag") > 0).cast("double")
    return {
        "years_smoking_x_heavy": years * heavy,
        "years_smoking_x_spd": years * number(df, "smokes_per_day"),
    }


def build_features(
    df: DataFrame,
    target: str | None = None,
    *,
    only: Iterable[str] | None = None,
    exclude: Iterable[str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """All built-in features; the target, if any, stays in the table."""
    return REGISTRY.build(df, only=only, exclude=exclude, key=key)
