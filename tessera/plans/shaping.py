"""Bindings of column shaping, repair, union and feature operators to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import encode as E
from tessera.functions import numeric as N
from tessera.operators import columns as C
from tessera.operators import features as FE
from tessera.operators.combine import union_common
from tessera.plans.common import rounded, table

# fixed values of the bindings
PRIORITY_RANK = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}
STATUS_NAME = {"F": "finished", "O": "open"}
PRIORITY_BAND = {"1-URGENT": 10, "2-HIGH": 20, "3-MEDIUM": 30, "4-NOT SPECIFIED": 40}


def _orders(spark, sf, *cols):
    return table(spark, sf, "orders", *cols)


def q_scan_filter(spark, sf):
    o = _orders(spark, sf, "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return rounded(o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000.0))
                   .select("o_orderkey", "o_custkey", "o_totalprice"))


def q_binary_encode(spark, sf):
    o = _orders(spark, sf, "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))  # P -> null
    return o.select(
        "o_orderkey",
        E.flag(status, "F").alias("is_finished"),
        E.any_flag([(F.col("o_orderpriority"), "1-URGENT"), (F.col("o_orderpriority"), "2-HIGH")])
        .alias("is_urgent_or_high"),
        E.member_flag(status, ["F", "O"]).alias("is_known_status"),
        E.threshold_flag("o_totalprice", 100000.0, ">").alias("is_large"))


def q_map_default(spark, sf):
    o = _orders(spark, sf, "o_orderkey", "o_orderstatus", "o_orderpriority")
    return o.select(
        "o_orderkey",
        E.map_default("o_orderpriority", PRIORITY_RANK, 2).cast("int").alias("priority_rank"),
        E.map_default("o_orderstatus", STATUS_NAME, "other").alias("status_name"))


def q_band_midpoint(spark, sf):
    o = _orders(spark, sf, "o_orderkey", "o_orderpriority")
    return o.select("o_orderkey",
                    E.map_default("o_orderpriority", PRIORITY_BAND, 50).cast("int").alias("band_mid"))


def q_map_nullable(spark, sf):
    lab = table(spark, sf, "labels", "doc_id", "quality", "toxic")
    code = (F.when(F.col("toxic") == 1, F.lit("maybe"))
            .when(F.col("quality") == 1, F.lit(" true"))
            .otherwise(F.lit("FALSE")))
    return lab.select("doc_id", E.map_nullable(code).alias("quality_code"))


def _harmonised(spark, sf):
    cust = C.tag_source(C.rename(table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal",
                                       "c_mktsegment"),
                                 {"c_custkey": "key", "c_nationkey": "nationkey", "c_acctbal": "acctbal",
                                  "c_mktsegment": "segment"}), "customer")
    supp = C.tag_source(C.rename(table(spark, sf, "supplier", "s_suppkey", "s_nationkey", "s_acctbal"),
                                 {"s_suppkey": "key", "s_nationkey": "nationkey", "s_acctbal": "acctbal"}),
                        "supplier")
    return cust, supp


def q_harmonise_union(spark, sf):
    cust, supp = _harmonised(spark, sf)
    return rounded(union_common([cust, supp]))


def q_union_common(spark, sf):
    cust, supp = _harmonised(spark, sf)
    return rounded(union_common([cust, None, supp], fill_missing=True))


def q_coerce_numeric(spark, sf):
    ev = table(spark, sf, "events", "event_id", "event_type", "props")
    ev = ev.select("event_id", F.get_json_object("props", "$.k").alias("k"),
                   F.col("event_type").alias("event_type_num"),
                   F.get_json_object("props", "$.k").alias("k_or_zero"))
    out = C.coerce_numeric(ev)
    return rounded(out.withColumn("k_or_zero", F.coalesce("k_or_zero", F.lit(0.0))))


def q_one_hot(spark, sf):
    o = _orders(spark, sf, "o_orderkey", "o_orderstatus")
    o = o.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    return C.one_hot(o, "o_orderstatus", "status")


def _acct(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal", "c_nationkey")
    return c.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))


def q_fill_const(spark, sf):
    c = _acct(spark, sf).withColumn(
        "bal_per_nation", F.try_divide(F.col("c_acctbal"), (F.col("c_nationkey") % 5).cast("double")))
    return rounded(C.fill_const(c, 0.0, ["c_acctbal", "bal_per_nation"]))


def q_fill_median(spark, sf):
    return rounded(C.fill_median(_acct(spark, sf), ["c_acctbal"]))


def q_null_audit(spark, sf):
    return C.null_audit(_acct(spark, sf))


def _part(spark, sf):
    return table(spark, sf, "part", "p_partkey", "p_size", "p_retailprice")


def _line(spark, sf):
    return table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax")


def q_square(spark, sf):
    return rounded(_part(spark, sf).select("p_partkey", N.square("p_size").alias("size_squared")))


def q_bin_right_closed(spark, sf):
    p = _part(spark, sf)
    return p.select("p_partkey", N.bin_right_closed("p_size", [0, 10, 25, 40, 45], 1.0).alias("size_bin"))


def q_threshold_flag(spark, sf):
    li = _line(spark, sf)
    return li.select("l_orderkey", "l_linenumber",
                     E.threshold_flag("l_quantity", 25, ">=").alias("big_qty"),
                     E.threshold_flag("l_discount", 0.05, ">").alias("high_discount"))


def q_abs_deviation(spark, sf):
    return rounded(_part(spark, sf).select("p_partkey", N.abs_deviation("p_size", 25).alias("size_dev")))


def q_outside_range(spark, sf):
    li = _line(spark, sf)
    return li.select("l_orderkey", "l_linenumber", N.outside_range("l_quantity", 6, 45).alias("odd_qty"))


def q_safe_ratio(spark, sf):
    li = _line(spark, sf)
    return rounded(li.select("l_orderkey", "l_linenumber",
                             N.safe_ratio("l_tax", "l_discount").alias("tax_per_discount")))


def q_row_sum(spark, sf):
    li = _line(spark, sf).withColumn("l_tax", F.when(F.col("l_tax") > 0.02, F.col("l_tax")))
    return rounded(li.select("l_orderkey", "l_linenumber",
                             N.row_sum(["l_discount", "l_tax", "l_quantity"]).alias("row_total")))


def q_interaction(spark, sf):
    li = _line(spark, sf)
    return rounded(li.select("l_orderkey", "l_linenumber",
                             N.product("l_quantity", "l_discount").alias("qty_x_discount")))


def survey_input(spark, sf):
    """lineitem columns dressed as the survey schema (a binding, not data synthesis)."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") * 2).alias("Age"),
        (F.col("l_extendedprice") / 2000.0).alias("BMI"),
        (F.col("l_linenumber") - 1).cast("double").alias("PhysicalHealth"),
        F.round(F.col("l_tax") * 100 - 1, 0).alias("MentalHealth"),
        E.flag("l_returnflag", "R").alias("Smoking"),
        E.flag("l_linestatus", "O").alias("AlcoholDrinking"),
        E.threshold_flag("l_discount", 0.08, ">").alias("Stroke"),
        E.threshold_flag("l_quantity", 45, ">").alias("DiffWalking"),
        E.flag("l_returnflag", "A").alias("KidneyDisease"),
        E.threshold_flag("l_tax", 0.07, ">").alias("SkinCancer"),
        (F.col("l_linenumber") % 3).cast("double").alias("Diabetic"),
        (F.col("l_quantity") % 12).alias("SleepTime"),
        (F.col("l_linenumber") % 5).cast("double").alias("GenHealth"))


def clinical_input(spark, sf):
    o = _orders(spark, sf, "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return o.select(
        "o_orderkey",
        (F.col("o_custkey") % 80).cast("double").alias("Age"),
        (F.col("o_totalprice") / 1500.0).alias("trestbps"),
        (F.col("o_totalprice") / 1000.0).alias("chol"),
        (60 + F.col("o_orderkey") % 140).cast("double").alias("thalch"),
        ((F.col("o_orderkey") % 60) / 10.0).alias("oldpeak"),
        E.flag("o_orderstatus", "F").alias("fbs"))


def q_survey_features(spark, sf):
    df = survey_input(spark, sf)
    return rounded(FE.survey_features(df).select("l_orderkey", "l_linenumber", *FE.SURVEY_FEATURES))


def q_clinical_features(spark, sf):
    df = clinical_input(spark, sf)
    return rounded(FE.clinical_features(df).select("o_orderkey", *FE.CLINICAL_FEATURES))


QUERIES = {
    "scan_filter": q_scan_filter,
    "binary_encode": q_binary_encode,
    "map_default": q_map_default,
    "band_midpoint": q_band_midpoint,
    "map_nullable": q_map_nullable,
    "harmonise_union": q_harmonise_union,
    "union_common": q_union_common,
    "coerce_numeric": q_coerce_numeric,
    "one_hot": q_one_hot,
    "fill_const": q_fill_const,
    "fill_median": q_fill_median,
    "null_audit": q_null_audit,
    "square": q_square,
    "bin_right_closed": q_bin_right_closed,
    "threshold_flag": q_threshold_flag,
    "abs_deviation": q_abs_deviation,
    "outside_range": q_outside_range,
    "safe_ratio": q_safe_ratio,
    "row_sum": q_row_sum,
    "interaction": q_interaction,
    "survey_features": q_survey_features,
    "clinical_features": q_clinical_features,
}

_SURVEY_IN = """
s AS (SELECT l_orderkey, l_linenumber, l_quantity * 2 AS Age, l_extendedprice / 2000.0 AS BMI,
    CAST(l_linenumber - 1 AS DOUBLE) AS PhysicalHealth, round(l_tax * 100 - 1, 0) AS MentalHealth,
    CAST(coalesce(l_returnflag = 'R', false) AS INTEGER) AS Smoking,
    CAST(coalesce(l_linestatus = 'O', false) AS INTEGER) AS AlcoholDrinking,
    CAST(coalesce(l_discount > 0.08, false) AS INTEGER) AS Stroke,
    CAST(coalesce(l_quantity > 45, false) AS INTEGER) AS DiffWalking,
    CAST(coalesce(l_returnflag = 'A', false) AS INTEGER) AS KidneyDisease,
    CAST(coalesce(l_tax > 0.07, false) AS INTEGER) AS SkinCancer,
    CAST(l_linenumber % 3 AS DOUBLE) AS Diabetic, l_quantity % 12 AS SleepTime,
    CAST(l_linenumber % 5 AS DOUBLE) AS GenHealth FROM lineitem)
"""


def _bins(col, edges):
    parts = " ".join(f"WHEN {col} > {float(edges[i])} AND {col} <= {float(edges[i + 1])} THEN {float(i)}"
                     for i in range(len(edges) - 1))
    return f"CASE {parts} ELSE 1.0 END"


def _fix(expr):
    """NULL / NaN / inf -> 0 (the recipe's final repair) for a double expression."""
    return f"(CASE WHEN ({expr}) IS NULL OR isnan({expr}) OR isinf({expr}) THEN 0.0 ELSE ({expr}) END)"


ORACLE = {
    "scan_filter": """SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice > 100000.0""",
    "binary_encode": """SELECT o_orderkey,
        CAST(coalesce(nullif(o_orderstatus, 'P') = 'F', false) AS INTEGER) AS is_finished,
        CAST(coalesce(o_orderpriority = '1-URGENT', false) OR coalesce(o_orderpriority = '2-HIGH', false) AS INTEGER)
          AS is_urgent_or_high,
        CAST(coalesce(nullif(o_orderstatus, 'P') IN ('F', 'O'), false) AS INTEGER) AS is_known_status,
        CAST(coalesce(o_totalprice > 100000.0, false) AS INTEGER) AS is_large FROM orders""",
    "map_default": """SELECT o_orderkey,
        CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2
             WHEN '4-NOT SPECIFIED' THEN 1 ELSE 2 END AS INTEGER) AS priority_rank,
        CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status_name
        FROM orders""",
    "band_midpoint": """SELECT o_orderkey,
        CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 20 WHEN '3-MEDIUM' THEN 30
             WHEN '4-NOT SPECIFIED' THEN 40 ELSE 50 END AS INTEGER) AS band_mid FROM orders""",
    "map_nullable": """SELECT doc_id, CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN 1 ELSE 0 END AS quality_code
        FROM labels""",
    "harmonise_union": """SELECT round(c_acctbal, 6) AS acctbal, c_custkey AS key, c_nationkey AS nationkey,
          'customer' AS source FROM customer
        UNION ALL SELECT round(s_acctbal, 6), s_suppkey, s_nationkey, 'supplier' FROM supplier""",
    "union_common": """SELECT round(c_acctbal, 6) AS acctbal, c_custkey AS key, c_nationkey AS nationkey,
          c_mktsegment AS segment, 'customer' AS source FROM customer
        UNION ALL SELECT round(s_acctbal, 6), s_suppkey, s_nationkey, NULL, 'supplier' FROM supplier""",
    "coerce_numeric": """SELECT event_id, round(TRY_CAST(trim(json_extract_string(props, '$.k')) AS DOUBLE), 6) AS k,
        TRY_CAST(trim(event_type) AS DOUBLE) AS event_type_num,
        round(coalesce(TRY_CAST(trim(json_extract_string(props, '$.k')) AS DOUBLE), 0.0), 6) AS k_or_zero
        FROM events""",
    "one_hot": """SELECT o_orderkey,
        CAST(coalesce(nullif(o_orderstatus, 'P') = 'F', false) AS INTEGER) AS status_F,
        CAST(coalesce(nullif(o_orderstatus, 'P') = 'O', false) AS INTEGER) AS status_O FROM orders""",
    "fill_const": """SELECT c_custkey, c_nationkey,
        round(coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0.0), 6) AS c_acctbal,
        round(coalesce(CASE WHEN c_acctbal >= 0 AND c_nationkey % 5 <> 0
                            THEN c_acctbal / CAST(c_nationkey % 5 AS DOUBLE) END, 0.0), 6) AS bal_per_nation
        FROM customer""",
    "fill_median": """SELECT c_custkey, c_nationkey,
        round(coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END,
              (SELECT median(c_acctbal) FROM customer WHERE c_acctbal >= 0)), 6) AS c_acctbal FROM customer""",
    "null_audit": """SELECT 'c_custkey' AS column_name, CAST(count_if(c_custkey IS NULL) AS BIGINT) AS n_null FROM customer
        UNION ALL SELECT 'c_acctbal', CAST(count_if(c_acctbal IS NULL OR c_acctbal < 0 OR isnan(c_acctbal)) AS BIGINT)
          FROM customer
        UNION ALL SELECT 'c_nationkey', CAST(count_if(c_nationkey IS NULL) AS BIGINT) FROM customer""",
    "square": "SELECT p_partkey, round(CAST(p_size AS DOUBLE) * p_size, 6) AS size_squared FROM part",
    "bin_right_closed": f"SELECT p_partkey, {_bins('p_size', [0, 10, 25, 40, 45])} AS size_bin FROM part",
    "threshold_flag": """SELECT l_orderkey, l_linenumber, CAST(coalesce(l_quantity >= 25, false) AS INTEGER) AS big_qty,
        CAST(coalesce(l_discount > 0.05, false) AS INTEGER) AS high_discount FROM lineitem""",
    "abs_deviation": "SELECT p_partkey, round(abs(CAST(p_size AS DOUBLE) - 25.0), 6) AS size_dev FROM part",
    "outside_range": """SELECT l_orderkey, l_linenumber,
        CAST(coalesce(l_quantity < 6 OR l_quantity > 45, false) AS INTEGER) AS odd_qty FROM lineitem""",
    "safe_ratio": """SELECT l_orderkey, l_linenumber,
        round(CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount END, 6) AS tax_per_discount FROM lineitem""",
    "row_sum": """SELECT l_orderkey, l_linenumber,
        round(coalesce(l_discount, 0.0) + coalesce(CASE WHEN l_tax > 0.02 THEN l_tax END, 0.0)
              + coalesce(l_quantity, 0.0), 6) AS row_total FROM lineitem""",
    "interaction": "SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) AS qty_x_discount FROM lineitem",
    "survey_features": "WITH " + _SURVEY_IN + f"""
SELECT l_orderkey, l_linenumber,
  round({_fix('Age * Age')}, 6) AS age_squared, {_bins('Age', [0, 35, 50, 65, 100])} AS age_bin,
  CAST(coalesce(Age >= 65, false) AS INTEGER) AS is_senior,
  round({_fix('BMI * BMI')}, 6) AS bmi_squared, {_bins('BMI', [0, 18.5, 25, 30, 100])} AS bmi_category,
  CAST(coalesce(BMI >= 30, false) AS INTEGER) AS is_obese,
  round({_fix('PhysicalHealth + MentalHealth')}, 6) AS total_health_burden,
  round(CASE WHEN MentalHealth + 1.0 = 0 THEN 0.0 ELSE {_fix('PhysicalHealth / (MentalHealth + 1.0)')} END, 6)
    AS health_ratio,
  round(CAST(Smoking AS DOUBLE) + AlcoholDrinking + Stroke + DiffWalking + KidneyDisease + SkinCancer + Diabetic, 6)
    AS risk_factor_count,
  round(abs(SleepTime - 7.0), 6) AS sleep_deviation,
  CAST(coalesce(SleepTime < 6 OR SleepTime > 9, false) AS INTEGER) AS poor_sleep,
  round({_fix('Age * BMI')}, 6) AS age_x_bmi, round(Age * Smoking, 6) AS age_x_smoking,
  round(GenHealth * PhysicalHealth, 6) AS genhealth_x_physical
FROM s""",
    "clinical_features": f"""WITH c AS (SELECT o_orderkey, CAST(o_custkey % 80 AS DOUBLE) AS Age,
    o_totalprice / 1500.0 AS trestbps, o_totalprice / 1000.0 AS chol,
    CAST(60 + o_orderkey % 140 AS DOUBLE) AS thalch, (o_orderkey % 60) / 10.0 AS oldpeak,
    CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER) AS fbs FROM orders)
SELECT o_orderkey, round(Age * Age, 6) AS age_squared, CAST(coalesce(Age >= 60, false) AS INTEGER) AS is_senior,
  {_bins('trestbps', [0, 120, 130, 140, 300])} AS bp_category,
  {_bins('chol', [0, 200, 240, 1000])} AS chol_category,
  CAST(coalesce(chol > 240, false) AS INTEGER) AS high_chol,
  round(220.0 - Age - thalch, 6) AS hr_reserve, round(oldpeak * Age, 6) AS oldpeak_x_age,
  CAST(coalesce(Age > 55, false) AS INTEGER) + CAST(coalesce(trestbps > 140, false) AS INTEGER)
    + CAST(coalesce(chol > 240, false) AS INTEGER) + fbs AS clinical_risk_score
FROM c""",
}
