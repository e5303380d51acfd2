"""Derived feature recipes.

Each feature is added only when its inputs exist (the schema is decided on
the driver from ``df.columns``; the plan is then fixed).  The recipes are
pure: applying one twice yields the same columns, because every feature is
assigned by name.  After all features, NULL/NaN/inf in numeric columns -> 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.encode import threshold_flag
from tessera.functions.numeric import (abs_deviation, bin_right_closed, outside_range, product,
                                       row_sum, safe_ratio, square)
from tessera.operators.columns import fill_const

# fixed values: bin edges (right-closed) and thresholds of the two recipes
AGE_EDGES = [0, 35, 50, 65, 100]
BMI_EDGES = [0, 18.5, 25, 30, 100]
BP_EDGES = [0, 120, 130, 140, 300]
CHOL_EDGES = [0, 200, 240, 1000]
SURVEY_SENIOR_AGE = 65
CLINICAL_SENIOR_AGE = 60
OBESE_BMI = 30
HIGH_CHOL = 240
SLEEP_CENTRE = 7
SLEEP_LOW, SLEEP_HIGH = 6, 9
RISK_COLUMNS = ["Smoking", "AlcoholDrinking", "Stroke", "DiffWalking", "KidneyDisease",
                "SkinCancer", "Diabetic"]
CLINICAL_RISK_AGE, CLINICAL_RISK_BP = 55, 140
MAX_HEART_RATE_BASE = 220

SURVEY_FEATURES = ["age_squared", "age_bin", "is_senior", "bmi_squared", "bmi_category", "is_obese",
                   "total_health_burden", "health_ratio", "risk_factor_count", "sleep_deviation",
                   "poor_sleep", "age_x_bmi", "age_x_smoking", "genhealth_x_physical"]
CLINICAL_FEATURES = ["age_squared", "is_senior", "bp_category", "chol_category", "high_chol",
                     "hr_reserve", "oldpeak_x_age", "clinical_risk_score"]


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def survey_feature_exprs(df: DataFrame) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if _has(df, "Age"):
        out["age_squared"] = square("Age")
        out["age_bin"] = bin_right_closed("Age", AGE_EDGES, default=1.0)
        out["is_senior"] = threshold_flag("Age", SURVEY_SENIOR_AGE, ">=")
    if _has(df, "BMI"):
        out["bmi_squared"] = square("BMI")
        out["bmi_category"] = bin_right_closed("BMI", BMI_EDGES, default=1.0)
        out["is_obese"] = threshold_flag("BMI", OBESE_BMI, ">=")
    if _has(df, "PhysicalHealth", "MentalHealth"):
        out["total_health_burden"] = F.col("PhysicalHealth").cast("double") + F.col("MentalHealth").cast("double")
        out["health_ratio"] = safe_ratio(F.col("PhysicalHealth"), F.col("MentalHealth").cast("double") + 1.0)
    risk = [c for c in RISK_COLUMNS if c in df.columns]
    if risk:
        out["risk_factor_count"] = row_sum(risk)
    if _has(df, "SleepTime"):
        out["sleep_deviation"] = abs_deviation("SleepTime", SLEEP_CENTRE)
        out["poor_sleep"] = outside_range("SleepTime", SLEEP_LOW, SLEEP_HIGH)
    if _has(df, "Age", "BMI"):
        out["age_x_bmi"] = product("Age", "BMI")
    if _has(df, "Age", "Smoking"):
        out["age_x_smoking"] = product("Age", "Smoking")
    if _has(df, "GenHealth", "PhysicalHealth"):
        out["genhealth_x_physical"] = product("GenHealth", "PhysicalHealth")
    return out


def clinical_feature_exprs(df: DataFrame) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if _has(df, "Age"):
        out["age_squared"] = square("Age")
        out["is_senior"] = threshold_flag("Age", CLINICAL_SENIOR_AGE, ">=")
    if _has(df, "trestbps"):
        out["bp_category"] = bin_right_closed("trestbps", BP_EDGES, default=1.0)
    if _has(df, "chol"):
        out["chol_category"] = bin_right_closed("chol", CHOL_EDGES, default=1.0)
        out["high_chol"] = threshold_flag("chol", HIGH_CHOL, ">")
    if _has(df, "thalch"):
        out["hr_reserve"] = (F.lit(float(MAX_HEART_RATE_BASE)) - F.col("Age").cast("double")
                             - F.col("thalch").cast("double")) if _has(df, "Age") else F.lit(0.0)
    if _has(df, "oldpeak", "Age"):
        out["oldpeak_x_age"] = product("oldpeak", "Age")
    parts = []
    if _has(df, "Age"):
        parts.append(threshold_flag("Age", CLINICAL_RISK_AGE, ">"))
    if _has(df, "trestbps"):
        parts.append(threshold_flag("trestbps", CLINICAL_RISK_BP, ">"))
    if _has(df, "chol"):
        parts.append(threshold_flag("chol", HIGH_CHOL, ">"))
    if _has(df, "fbs"):
        parts.append(F.col("fbs").cast("int"))
    if parts:
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        out["clinical_risk_score"] = total
    return out


def _apply(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    return fill_const(df.withColumns(exprs), 0.0)


def survey_features(df: DataFrame) -> DataFrame:
    """The 14 survey features (as inputs allow), then NULL/NaN/inf -> 0."""
    return _apply(df, survey_feature_exprs(df))


def clinical_features(df: DataFrame) -> DataFrame:
    """The 8 clinical features (as inputs allow), then NULL/NaN/inf -> 0."""
    return _apply(df, clinical_feature_exprs(df))
