"""The 2022 and Cleveland loaders on small CSV files, and the report sinks."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.sources import health as H
from tessera.sources.tables import nested_report, read_report, write_report

FIELDS_2022 = [c.split()[0] for c in H.SURVEY_2022_SCHEMA.split(", ")]
DEFAULTS_2022 = {"State": "Ohio", "Sex": "Female", "GeneralHealth": "Good", "PhysicalHealthDays": "1", "MentalHealthDays": "2", "SleepHours": "7", "BMI": "25.0",
                 "PhysicalActivities": "Yes", "RaceEthnicityCategory": "White only, Non-Hispanic", "AgeCategory": "Age 35 to 39", "SmokerStatus": "Never smoked"}
ROWS_2022 = [
    {"BMI": "21.0", "HadHeartAttack": "No", "HadAngina": "Yes", "Sex": "Male", "SmokerStatus": "Current smoker - now smokes some days",
     "HadDiabetes": "Yes", "GeneralHealth": "Excellent", "AgeCategory": "Age 80 or older", "RaceEthnicityCategory": "Black only, Non-Hispanic", "HadStroke": "Yes"},
    {"BMI": "22.0", "HadHeartAttack": "Yes", "HadDiabetes": "No, pre-diabetes or borderline diabetes", "SmokerStatus": "Former smoker",
     "RaceEthnicityCategory": "Multiracial, Non-Hispanic", "DifficultyWalking": "Yes", "AlcoholDrinkers": "Yes"},
    {"BMI": "23.0", "HadDiabetes": "Yes, but only during pregnancy (female)", "RaceEthnicityCategory": "unknown to us", "AgeCategory": "older", "GeneralHealth": "",
     "PhysicalHealthDays": "", "SmokerStatus": "Current smoker - now smokes every day", "HadSkinCancer": "Yes"},
]


def put(folder, name, header, rows):
    with open(os.path.join(folder, name), "w") as out:
        for row in [header, *rows]:
            out.write(",".join(f'"{v}"' if "," in v else v for v in row) + "\n")


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="tessera-raw-")


def test_survey_2022_codes_and_kept_columns(spark, folder):
    put(folder, H.SURVEY_2022_FILE, FIELDS_2022, [[{**DEFAULTS_2022, **r}.get(c, "No") for c in FIELDS_2022] for r in ROWS_2022])
    t = H.build_survey_table(spark, folder)
    one, two, three = (r.asDict() for r in t.orderBy("BMI").collect())
    names = ["HeartDisease", "Sex", "Smoking", "Diabetic", "GenHealth", "Age", "Stroke", "DiffWalking", "AlcoholDrinking", "SkinCancer", "PhysicalActivity"]
    assert [one[n] for n in names] == [1, 1, 1, 2, 4, 82, 1, 0, 0, 0, 1]
    assert [two[n] for n in names] == [1, 0, 0, 1, 2, 37, 0, 1, 1, 0, 1]
    assert [three[n] for n in names] == [0, 0, 1, 1, 2, 50, 0, 0, 0, 1, 1]
    assert [(r["PhysicalHealth"], r["MentalHealth"], r["SleepTime"]) for r in (one, two, three)] == [(1, 2, 7), (1, 2, 7), (0, 2, 7)]  # copied columns
    assert [(r["Race_Black"], r["Race_Other"]) for r in (one, two, three)] == [(1, 0), (0, 1), (0, 1)]
    # the keep list: common names, race columns and the source; nothing else of the 40 columns
    assert set(t.columns) == {*H.SURVEY_COMMON, "Race_Black", "Race_Other", "source"}
    assert {r.source for r in t.collect()} == {"brfss_2022"}


def test_both_years_share_their_common_columns(spark, folder):
    put(folder, H.SURVEY_2022_FILE, FIELDS_2022, [[{**DEFAULTS_2022, **r}.get(c, "No") for c in FIELDS_2022] for r in ROWS_2022])
    names = [c.split()[0] for c in H.SURVEY_2020_SCHEMA.split(", ")]
    put(folder, H.SURVEY_2020_FILE, names, [[{"BMI": "30", "PhysicalHealth": "0", "MentalHealth": "0", "SleepTime": "8", "Sex": "Male", "AgeCategory": "18-24",
                                              "Race": "Black", "GenHealth": "Fair"}.get(c, "No") for c in names]])
    t = H.build_survey_table(spark, folder)
    assert t.groupBy("source").count().orderBy("source").collect() == [("brfss_2020", 1), ("brfss_2022", 3)]
    assert {"Race_Black", "HeartDisease", "Age"} <= set(t.columns) and not {"AgeCategory", "State", "HadAngina"} & set(t.columns)
    assert t.where("source = 'brfss_2020'").select("Age", "GenHealth", "Race_Black").first() == (21, 1, 1)


def test_cleveland_renames(spark, folder):
    names = [c.split()[0] for c in H.CLINICAL_CLEVELAND_SCHEMA.split(", ")]
    rows = [["69", "1", "0", "160", "234", "1", "2", "131", "0", "0.1", "1", "1", "0", "0"], ["66", "0", "0", "150", "", "0", "0", "114", "0", "2.6", "2", "0", "0", "1"],
            ["61", "1", "3", "134", "240", "0", "0", "145", "0", "2.6", "1", "2", "0", "1"]]
    put(folder, H.CLINICAL_CLEVELAND_FILE, names, rows)
    t = H.build_clinical_table(spark, folder)
    got = [(r.Age, r.Sex, r.thalch, r.target, r.chol, r.source) for r in t.orderBy("Age").collect()]
    assert got == [(61, 1, 145, 1, 240, "cleveland"), (66, 0, 114, 1, 237, "cleveland"), (69, 1, 131, 0, 234, "cleveland")]
    assert not {"condition", "thalach", "age"} & set(t.columns)


def test_reports_come_back_as_written(spark, tmp_path):
    long = spark.createDataFrame([(1, "a", 0.5, True), (1, "b", None, None), (2, "a", 1e-9, False)], "batch int, feature string, p double, drifted boolean")
    report = nested_report(long, ["batch"], "feature", ["p", "drifted"])
    write_report(report, str(tmp_path / "j"))
    back = read_report(spark, str(tmp_path / "j"), report.schema)
    assert back.schema.simpleString() == report.schema.simpleString()
    flat = back.select("batch", F.explode("feature_results").alias("feature", "r")).select("batch", "feature", "r.*")
    assert sorted(map(str, flat.collect())) == sorted(map(str, long.collect()))
    write_report(long, str(tmp_path / "c"), "csv")
    assert sorted(map(str, read_report(spark, str(tmp_path / "c"), long.schema, "csv").collect())) == sorted(map(str, long.collect()))
    with pytest.raises(ValueError):
        write_report(long, str(tmp_path / "x"), "xml")
