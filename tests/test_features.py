"""Feature recipes on the inline fixtures with hand-computed values, plus edge rows."""
import pytest
from pyspark.sql import functions as F

from tessera.operators import features as FE

SURVEY_COLS = ["Age", "BMI", "PhysicalHealth", "MentalHealth", "Smoking", "AlcoholDrinking", "Stroke",
               "DiffWalking", "KidneyDisease", "SkinCancer", "Diabetic", "SleepTime", "GenHealth"]


def _survey(spark, rows):
    schema = ", ".join(f"{c} double" for c in SURVEY_COLS)
    return spark.createDataFrame(rows, schema)


def test_survey_recipe_hand_values(spark):
    df = _survey(spark, [(55.0, 28.5, 5.0, 3.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 7.0, 2.0),
                         (30.0, 22.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 8.0, 3.0)])
    out = FE.survey_features(df).orderBy(F.col("Age").desc()).collect()
    exp = [dict(age_squared=3025, age_bin=2, is_senior=0, bmi_squared=812.25, bmi_category=2, is_obese=0,
                total_health_burden=8, health_ratio=1.25, risk_factor_count=1, sleep_deviation=0, poor_sleep=0,
                age_x_bmi=1567.5, age_x_smoking=55, genhealth_x_physical=10),
           dict(age_squared=900, age_bin=0, is_senior=0, bmi_squared=484, bmi_category=1, is_obese=0,
                total_health_burden=1, health_ratio=0, risk_factor_count=0, sleep_deviation=1, poor_sleep=0,
                age_x_bmi=660, age_x_smoking=0, genhealth_x_physical=0)]
    for row, e in zip(out, exp):
        for k, v in e.items():
            assert row[k] == pytest.approx(v), k


def test_clinical_recipe_hand_values(spark):
    df = spark.createDataFrame([(55.0, 130.0, 250.0, 150.0, 1.5, 1), (60.0, 160.0, 200.0, 120.0, 2.0, 0)],
                               "Age double, trestbps double, chol double, thalch double, oldpeak double, fbs int")
    out = FE.clinical_features(df).orderBy("Age").collect()
    exp = [dict(age_squared=3025, is_senior=0, bp_category=1, chol_category=2, high_chol=1, hr_reserve=15,
                oldpeak_x_age=82.5, clinical_risk_score=2),
           dict(age_squared=3600, is_senior=1, bp_category=3, chol_category=0, high_chol=0, hr_reserve=40,
                oldpeak_x_age=120, clinical_risk_score=2)]
    for row, e in zip(out, exp):
        for k, v in e.items():
            assert row[k] == pytest.approx(v), k


def test_right_closed_bins_and_outside_values(spark):
    ages = [35.0, 50.0, 65.0, 100.0, 101.0, 0.0]
    df = spark.createDataFrame([(a, 18.5 if i == 0 else 25.0 if i == 1 else 30.0) for i, a in enumerate(ages)],
                               "Age double, BMI double")
    out = {r["Age"]: r for r in FE.survey_features(df).collect()}
    assert [out[a]["age_bin"] for a in ages] == [0.0, 1.0, 2.0, 3.0, 1.0, 1.0]
    assert out[65.0]["is_senior"] == 1 and out[50.0]["is_senior"] == 0
    assert out[35.0]["bmi_category"] == 0.0 and out[50.0]["bmi_category"] == 1.0 and out[65.0]["bmi_category"] == 2.0
    assert out[65.0]["is_obese"] == 1


def test_inf_nan_and_null_repair(spark):
    df = spark.createDataFrame([(5.0, -1.0, None), (0.0, -1.0, 1.0)],
                               "PhysicalHealth double, MentalHealth double, Smoking double")
    out = FE.survey_features(df).orderBy(F.col("PhysicalHealth").desc()).collect()
    assert out[0]["health_ratio"] == 0.0 and out[1]["health_ratio"] == 0.0
    assert out[0]["risk_factor_count"] == 0.0 and out[1]["risk_factor_count"] == 1.0
    assert out[0]["Smoking"] == 0.0  # null repaired to 0 after the recipe


def test_recipe_is_idempotent(spark):
    df = _survey(spark, [(55.0, 28.5, 5.0, 3.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0, 7.0, 2.0)])
    once = FE.survey_features(df)
    twice = FE.survey_features(once)
    assert once.columns == twice.columns
    assert once.collect() == twice.collect()
