"""The reference's raw health sources: declared CSV schemas and harmonisers.

Five optional CSV files (two survey years, three clinical sets) are read with
declared schemas (codes as strings, no inference), mapped to common names and
codes by column expressions, and combined by a schema-intersecting union.
Level discovery (one-hot) is one ``distinct`` per code column; everything else
is a narrow projection.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.encode import any_flag, flag, map_default, map_nullable, member_flag
from tessera.operators.columns import coerce_numeric, fill_const, fill_median, keep_columns, one_hot, rename
from tessera.operators.combine import union_common
from tessera.sources.tables import read_csv_sources

# ---------------------------------------------------------------- fixed values
# file names of the five sources
SURVEY_2020_FILE = "heart_2020_cleaned.csv"
SURVEY_2022_FILE = "heart_2022_no_nans.csv"
CLINICAL_HEART_FILE = "heart.csv"
CLINICAL_UCI_FILE = "heart_disease_uci.csv"
CLINICAL_CLEVELAND_FILE = "heart_cleveland_upload.csv"

# diabetes codes -> 0/1/2 (unknown and missing -> 0)
DIABETES_2020 = {"Yes": 2, "No": 0, "No, borderline diabetes": 1, "Yes (during pregnancy)": 1}
DIABETES_2022 = {"Yes": 2, "No": 0, "No, pre-diabetes or borderline diabetes": 1,
                 "Yes, but only during pregnancy (female)": 1}
# general health -> 0..4 (unknown and missing -> 2)
GENERAL_HEALTH = {"Poor": 0, "Fair": 1, "Good": 2, "Very good": 3, "Excellent": 4}
# age band -> midpoint (unknown and missing -> 50)
AGE_2020 = {"18-24": 21, "25-29": 27, "30-34": 32, "35-39": 37, "40-44": 42, "45-49": 47, "50-54": 52,
            "55-59": 57, "60-64": 62, "65-69": 67, "70-74": 72, "75-79": 77, "80 or older": 82}
AGE_2022 = {"Age 18 to 24": 21, "Age 25 to 29": 27, "Age 30 to 34": 32, "Age 35 to 39": 37,
            "Age 40 to 44": 42, "Age 45 to 49": 47, "Age 50 to 54": 52, "Age 55 to 59": 57,
            "Age 60 to 64": 62, "Age 65 to 69": 67, "Age 70 to 74": 72, "Age 75 to 79": 77,
            "Age 80 or older": 82}
# race / ethnicity names of 2022 -> the 2020 names (unknown and missing -> "Other")
RACE_2022 = {"White only, Non-Hispanic": "White", "Black only, Non-Hispanic": "Black",
             "Hispanic": "Hispanic", "Asian only, Non-Hispanic": "Asian",
             "American Indian/Alaskan Native only, Non-Hispanic": "American Indian/Alaskan Native",
             "Other race only, Non-Hispanic": "Other", "Multiracial, Non-Hispanic": "Other"}
CURRENT_SMOKER_2022 = ["Current smoker - now smokes every day", "Current smoker - now smokes some days"]
SURVEY_COMMON = ["HeartDisease", "BMI", "Smoking", "AlcoholDrinking", "Stroke", "PhysicalHealth",
                 "MentalHealth", "DiffWalking", "Sex", "PhysicalActivity", "GenHealth", "SleepTime", "Asthma",
                 "KidneyDisease", "SkinCancer", "Diabetic", "Age"]
CLINICAL_HEART_RENAME = {"ChestPainType": "cp", "RestingBP": "trestbps", "Cholesterol": "chol",
                         "FastingBS": "fbs", "RestingECG": "restecg", "MaxHR": "thalch",
                         "ExerciseAngina": "exang", "Oldpeak": "oldpeak", "ST_Slope": "slope"}
CLEVELAND_RENAME = {"condition": "target", "age": "Age", "sex": "Sex", "thalach": "thalch"}
# -----------------------------------------------------------------------------


SURVEY_2020_SCHEMA = (
    "HeartDisease string, BMI double, Smoking string, AlcoholDrinking string, Stroke string, "
    "PhysicalHealth double, MentalHealth double, DiffWalking string, Sex string, AgeCategory string, "
    "Race string, Diabetic string, PhysicalActivity string, GenHealth string, SleepTime double, "
    "Asthma string, KidneyDisease string, SkinCancer string")
SURVEY_2022_SCHEMA = (
    "State string, Sex string, GeneralHealth string, PhysicalHealthDays double, MentalHealthDays double, "
    "LastCheckupTime string, PhysicalActivities string, SleepHours double, RemovedTeeth string, "
    "HadHeartAttack string, HadAngina string, HadStroke string, HadAsthma string, HadSkinCancer string, "
    "HadCOPD string, HadDepressiveDisorder string, HadKidneyDisease string, HadArthritis string, "
    "HadDiabetes string, DeafOrHardOfHearing string, BlindOrVisionDifficulty string, "
    "DifficultyConcentrating string, DifficultyWalking string, DifficultyDressingBathing string, "
    "DifficultyErrands string, SmokerStatus string, ECigaretteUsage string, ChestScan string, "
    "RaceEthnicityCategory string, AgeCategory string, HeightInMeters double, WeightInKilograms double, "
    "BMI double, AlcoholDrinkers string, HIVTesting string, FluVaxLast12 string, PneumoVaxEver string, "
    "TetanusLast10Tdap string, HighRiskLastYear string, CovidPos string")
CLINICAL_HEART_SCHEMA = (
    "Age double, Sex string, ChestPainType string, RestingBP double, Cholesterol double, FastingBS double, "
    "RestingECG string, MaxHR double, ExerciseAngina string, Oldpeak double, ST_Slope string, "
    "HeartDisease int")
CLINICAL_UCI_SCHEMA = (
    "id long, age double, sex string, dataset string, cp string, trestbps string, chol string, fbs string, "
    "restecg string, thalch string, exang string, oldpeak string, slope string, ca string, thal string, "
    "num int")
CLINICAL_CLEVELAND_SCHEMA = (
    "age double, sex double, cp double, trestbps double, chol double, fbs double, restecg double, "
    "thalach double, exang double, oldpeak double, slope double, ca double, thal double, condition int")


def harmonise_survey_2020(df: DataFrame) -> DataFrame:
    yes = ["HeartDisease", "Smoking", "AlcoholDrinking", "Stroke", "DiffWalking", "PhysicalActivity",
           "Asthma", "KidneyDisease", "SkinCancer"]
    out = df.withColumns({
        **{c: flag(c, "Yes") for c in yes},
        "Sex": flag("Sex", "Male"),
        "Diabetic": map_default("Diabetic", DIABETES_2020, 0),
        "GenHealth": map_default("GenHealth", GENERAL_HEALTH, 2),
        "Age": map_default("AgeCategory", AGE_2020, 50),
    })
    out = one_hot(out, "Race", "Race")
    return out.drop("AgeCategory").withColumn("source", F.lit("brfss_2020"))


def harmonise_survey_2022(df: DataFrame) -> DataFrame:
    out = df.withColumns({
        "HeartDisease": any_flag([("HadHeartAttack", "Yes"), ("HadAngina", "Yes")]),
        "Sex": flag("Sex", "Male"),
        "Smoking": member_flag("SmokerStatus", CURRENT_SMOKER_2022),
        "AlcoholDrinking": flag("AlcoholDrinkers", "Yes"),
        "Stroke": flag("HadStroke", "Yes"),
        "DiffWalking": flag("DifficultyWalking", "Yes"),
        "PhysicalActivity": flag("PhysicalActivities", "Yes"),
        "Asthma": flag("HadAsthma", "Yes"),
        "KidneyDisease": flag("HadKidneyDisease", "Yes"),
        "SkinCancer": flag("HadSkinCancer", "Yes"),
        "Diabetic": map_default("HadDiabetes", DIABETES_2022, 0),
        "GenHealth": map_default("GeneralHealth", GENERAL_HEALTH, 2),
        "Age": map_default("AgeCategory", AGE_2022, 50),
        "PhysicalHealth": F.col("PhysicalHealthDays"),
        "MentalHealth": F.col("MentalHealthDays"),
        "SleepTime": F.col("SleepHours"),
        "Race_mapped": map_default("RaceEthnicityCategory", RACE_2022, "Other"),
    })
    out = one_hot(out, "Race_mapped", "Race")
    return keep_columns(out, SURVEY_COMMON, ["Race_"]).withColumn("source", F.lit("brfss_2022"))


def harmonise_clinical_heart(df: DataFrame) -> DataFrame:
    out = rename(df, CLINICAL_HEART_RENAME).withColumns({"Sex": flag("Sex", "M"), "exang": flag("exang", "Y")})
    for col, prefix in (("cp", "cp"), ("restecg", "ecg"), ("slope", "slope")):
        out = one_hot(out, col, prefix)
    return rename(out, {"HeartDisease": "target"}).withColumn("source", F.lit("clinical_heart"))


def harmonise_clinical_uci(df: DataFrame) -> DataFrame:
    # column names resolve case-insensitively: build Sex apart from the raw sex first
    out = df.withColumns({
        "target": F.coalesce(F.col("num") > 0, F.lit(False)).cast("int"),
        "__sex": flag("sex", "Male"),
        "exang": map_nullable("exang"),
        "fbs": map_nullable("fbs"),
    }).drop("id", "sex", "dataset", "num").withColumnRenamed("__sex", "Sex")
    out = rename(out, {"age": "Age"})
    for col, prefix in (("cp", "cp"), ("restecg", "ecg"), ("slope", "slope"), ("thal", "thal")):
        out = one_hot(out, col, prefix)
    return coerce_numeric(out).withColumn("source", F.lit("uci"))


def harmonise_clinical_cleveland(df: DataFrame) -> DataFrame:
    return rename(df, CLEVELAND_RENAME).withColumn("source", F.lit("cleveland"))


def _read(spark: SparkSession, raw_dir: str, specs: dict) -> dict[str, DataFrame]:
    return read_csv_sources(spark, {k: (os.path.join(raw_dir, f), s) for k, (f, s) in specs.items()})


def build_survey_table(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Both survey years (whichever exist), common columns, nulls -> 0."""
    found = _read(spark, raw_dir, {"y2020": (SURVEY_2020_FILE, SURVEY_2020_SCHEMA),
                                   "y2022": (SURVEY_2022_FILE, SURVEY_2022_SCHEMA)})
    frames = [harmonise_survey_2020(found["y2020"]) if "y2020" in found else None,
              harmonise_survey_2022(found["y2022"]) if "y2022" in found else None]
    return fill_const(union_common(frames), 0.0)


def build_clinical_table(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The three clinical sets (whichever exist), common columns, strings coerced
    (except ``source``), nulls -> median of the pooled table."""
    found = _read(spark, raw_dir, {"heart": (CLINICAL_HEART_FILE, CLINICAL_HEART_SCHEMA),
                                   "uci": (CLINICAL_UCI_FILE, CLINICAL_UCI_SCHEMA),
                                   "cleveland": (CLINICAL_CLEVELAND_FILE, CLINICAL_CLEVELAND_SCHEMA)})
    fns = {"heart": harmonise_clinical_heart, "uci": harmonise_clinical_uci,
           "cleveland": harmonise_clinical_cleveland}
    frames = [fns[k](found[k]) if k in found else None for k in fns]
    pooled = coerce_numeric(union_common(frames), exclude=("source",))
    return fill_median(pooled, [c for c in pooled.columns if c != "source"])
