"""Raw-source harmonisers on small CSV fixtures (FIXTURES.md 1.x), and preparation invariants."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators.prepare import prepare_splits
from tessera.sources import health as H

S2020 = ("HeartDisease,BMI,Smoking,AlcoholDrinking,Stroke,PhysicalHealth,MentalHealth,DiffWalking,Sex,AgeCategory,"
         "Race,Diabetic,PhysicalActivity,GenHealth,SleepTime,Asthma,KidneyDisease,SkinCancer")
ROWS_2020 = [
    "Yes,28.5,Yes,No,No,5,3,No,Male,55-59,White,Yes,Yes,Good,7,No,No,No",
    "No,22.0,No,No,No,0,1,No,Female,30-34,Black,No,Yes,Very good,8,No,No,No",
    "No,31.0,No,Yes,No,2,0,Yes,Female,80 or older,Hispanic,\"No, borderline diabetes\",No,Poor,5,Yes,No,Yes",
    "No,,No,No,No,1,1,No,Male,unknown band,White,Yes (during pregnancy),Yes,odd,6,No,Yes,No",
]


def _write(folder, name, header, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")


@pytest.fixture()
def raw_dir():
    d = tempfile.mkdtemp(prefix="tessera-raw-")
    _write(d, H.SURVEY_2020_FILE, S2020, ROWS_2020)
    _write(d, H.CLINICAL_HEART_FILE,
           "Age,Sex,ChestPainType,RestingBP,Cholesterol,FastingBS,RestingECG,MaxHR,ExerciseAngina,Oldpeak,ST_Slope,"
           "HeartDisease", ["40,M,ATA,140,289,0,Normal,172,N,0,Up,0", "49,F,NAP,160,180,0,Normal,156,Y,1,Flat,1"])
    _write(d, H.CLINICAL_UCI_FILE,
           "id,age,sex,dataset,cp,trestbps,chol,fbs,restecg,thalch,exang,oldpeak,slope,ca,thal,num",
           ["1,63,Male,Cleveland,typical angina,145,233,TRUE,lv hypertrophy,150,FALSE,2.3,downsloping,0,fixed defect,0",
            "2,67,Male,Cleveland,asymptomatic,160,,FALSE,lv hypertrophy,108,TRUE,1.5,flat,3,normal,2",
            "3,37,Female,Hungary,non-anginal,130,250,,normal,187,x,3.5,downsloping,0,normal,1"])
    return d


def test_survey_2020_codes(spark, raw_dir):
    t = H.build_survey_table(spark, raw_dir)  # only the 2020 year exists: the other is skipped
    rows = {r["BMI"]: r for r in t.collect()}
    r = rows[28.5]
    assert (r["HeartDisease"], r["Smoking"], r["Sex"], r["Age"], r["Diabetic"], r["GenHealth"]) == (1, 1, 1, 57, 2, 2)
    r = rows[31.0]
    assert (r["Age"], r["Diabetic"], r["GenHealth"], r["Race_Hispanic"], r["Race_White"]) == (82, 1, 0, 1, 0)
    r = rows[0.0]  # missing BMI filled with 0; unknown codes take their defaults
    assert (r["Age"], r["Diabetic"], r["GenHealth"]) == (50, 1, 2)
    assert t.columns == sorted(t.columns)
    assert "source" in t.columns and "AgeCategory" not in t.columns


def test_clinical_pooled_median_fill(spark, raw_dir):
    t = H.build_clinical_table(spark, raw_dir)
    assert set(t.columns) >= {"Age", "Sex", "chol", "exang", "fbs", "oldpeak", "source", "target", "thalch",
                              "trestbps"}
    assert t.count() == 5
    nulls = t.select([F.count_if(F.col(c).isNull()).alias(c) for c in t.columns]).first().asDict()
    assert sum(nulls.values()) == 0
    chol = sorted(r["chol"] for r in t.collect())
    assert 233.0 in chol and 250.0 in chol  # the missing chol took the pooled median (the 3rd of 4 values' mean)
    assert sorted(r["target"] for r in t.collect()) == [0, 0, 1, 1, 1]


def test_no_source_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        H.build_survey_table(spark, tempfile.mkdtemp(prefix="tessera-empty-"))


def test_prepare_splits_invariants(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/customer.parquet").select(
        (F.col("c_mktsegment") == "AUTOMOBILE").cast("int").alias("HeartDisease"),
        "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    out = prepare_splits(df, "HeartDisease").cache()
    assert out.where(F.col("c_acctbal").isNull() | F.isnan("c_acctbal")).count() == 0
    counts = {(r["split"], r["HeartDisease"]): r["count"] for r in out.groupBy("split", "HeartDisease").count().collect()}
    assert counts[("train", 0)] == counts[("train", 1)]  # balanced after SMOTE
    real = out.where(~F.col("synthetic"))
    assert real.count() == df.count()
    assert out.where("split <> 'train' AND synthetic").count() == 0
