"""Panel features, labels, splits and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratline.models import sequence
from stratline.operators import eda, encode, panel, quality, rows, targets
from stratline.operators.ordering import next_in_order
from stratline.plans import carriers
from stratline.plans.carriers import EXTRACT_SQL, SETTINGS, SPARSE_SQL, table
from stratline.plans.queries_ingest import CLEAN_SQL, PREPARED_SQL, clean_panel, prepared
from stratline.plans.registry import query
from stratline.sources import sinks

TRAIN_MAX, VAL_MIN, VAL_MAX, TEST_MIN = (
    SETTINGS.train_max_year, SETTINGS.val_min_year, SETTINGS.val_max_year, SETTINGS.test_min_year,
)

SCALED_SQL = """
  CAST("YearStart" - (SELECT min("YearStart") FROM {t}) AS DOUBLE)
  / greatest((SELECT max("YearStart") - min("YearStart") FROM {t}), 1) AS year_normalized"""

LAGGED_SQL = f"""{SPARSE_SQL},
lagged AS (
  SELECT s.*, a."Data_Value" AS lag_1, b."Data_Value" AS lag_2,
    CASE WHEN a."Data_Value" IS NOT NULL AND b."Data_Value" IS NOT NULL
         THEN (a."Data_Value" + b."Data_Value") / 2
         ELSE coalesce(a."Data_Value", b."Data_Value") END AS rolling_mean_3,
    a."Data_Value" - b."Data_Value" AS trend_1yr
  FROM sparse s
  LEFT JOIN sparse a ON a.unit = s.unit AND a."YearStart" + 1 = s."YearStart"
  LEFT JOIN sparse b ON b.unit = s.unit AND b."YearStart" + 2 = s."YearStart")"""

LABELLED_PANEL_SQL = f"""{LAGGED_SQL},
limits AS (
  SELECT quantile_cont("Data_Value", 0.75) AS t FROM sparse WHERE "YearStart" <= {TRAIN_MAX}),
flagged AS (
  SELECT lagged.*, CAST("Data_Value" >= t AS INTEGER) AS high_risk_obesity FROM lagged, limits),
warned AS (
  SELECT *, CASE WHEN high_risk_obesity = 0 THEN
    lead(high_risk_obesity) OVER (PARTITION BY unit ORDER BY "YearStart") END AS early_warning
  FROM flagged)"""

SPLIT_SQL = f"""CASE WHEN "YearStart" <= {TRAIN_MAX} THEN 'train'
  WHEN "YearStart" BETWEEN {VAL_MIN} AND {VAL_MAX} THEN 'val'
  WHEN "YearStart" >= {TEST_MIN} THEN 'test' END"""


def lagged_from(base):
    return panel.lag_summary(panel.calendar_lags(base, ["unit"], unique=True))


def lagged(spark, sf):
    return lagged_from(carriers.sparse(spark, sf))


def warned_from(base):
    train = F.col("YearStart") <= TRAIN_MAX
    limit = rows.scalar(targets.threshold(base, 75, train), F.max("high_risk_threshold").alias("t"))
    flagged = targets.flag_high_risk(lagged_from(base), limit["t"])
    return targets.early_warning(flagged, ["unit"], unique=True)


def sparse_table(spark, sf):
    """The sparse panel, written once: threshold, scale and windows all read it."""
    return sinks.table_cut(spark)(carriers.sparse(spark, sf), "sparse")


def warned(spark, sf):
    return warned_from(sparse_table(spark, sf))


@query(f"""WITH {LABELLED_PANEL_SQL}
SELECT unit, "YearStart", "Data_Value", {SCALED_SQL.format(t='sparse')},
  "High_Confidence_Limit" - "Low_Confidence_Limit" AS ci_width,
  lag_1, lag_2, rolling_mean_3, trend_1yr, high_risk_obesity, early_warning, {SPLIT_SQL} AS split
FROM warned""")
def panel_model_table(spark, sf):
    """Flagship: lags, trend, precision, train-only risk label, early warning and split."""
    base = sparse_table(spark, sf)
    out = panel.ci_width(panel.year_scale(warned_from(base), fit=base))
    return out.withColumn("split", targets.split_name(F.col("YearStart"), SETTINGS)).select(
        "unit", "YearStart", "Data_Value", "year_normalized", "ci_width", "lag_1", "lag_2",
        "rolling_mean_3", "trend_1yr", "high_risk_obesity", "early_warning", "split",
    )


@query(f"""WITH {SPARSE_SQL} SELECT s.unit, s."YearStart", s."Data_Value",
  a."Data_Value" AS lag_1, b."Data_Value" AS lag_2 FROM sparse s
  LEFT JOIN sparse a ON a.unit = s.unit AND a."YearStart" + 1 = s."YearStart"
  LEFT JOIN sparse b ON b.unit = s.unit AND b."YearStart" + 2 = s."YearStart" """)
def calendar_lags(spark, sf):
    base = carriers.sparse(spark, sf).select("unit", "YearStart", "Data_Value")
    return panel.calendar_lags(base, ["unit"], unique=True)


NULL_KEY_SQL = f"""{SPARSE_SQL},
keyed AS (SELECT unit, CASE WHEN "Low_Confidence_Limit" IS NULL THEN NULL ELSE 'several' END AS part,
  "YearStart", "Data_Value" FROM sparse)"""


@query(f"""WITH {NULL_KEY_SQL} SELECT s.*, a."Data_Value" AS lag_1 FROM keyed s
LEFT JOIN keyed a ON a.unit = s.unit AND a.part IS NOT DISTINCT FROM s.part
  AND a."YearStart" + 1 = s."YearStart" """)
def lag_join_null_keys(spark, sf):
    base = carriers.sparse(spark, sf).select(
        "unit",
        F.when(F.col("Low_Confidence_Limit").isNotNull(), "several").alias("part"),
        "YearStart",
        "Data_Value",
    )
    return panel.lag_join(base, ["unit", "part"], lags=[1])


ORDER_ROWS_SQL = """
order_rows AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS "YearStart", o_orderkey,
  o_totalprice AS "Data_Value" FROM orders)"""


def order_rows(spark, sf):
    return table(spark, sf, "orders").select(
        "o_custkey",
        F.year("o_orderdate").alias("YearStart"),
        "o_orderkey",
        F.col("o_totalprice").alias("Data_Value"),
    )


@query(f"""WITH {ORDER_ROWS_SQL},
cells AS (SELECT o_custkey, "YearStart", arg_min("Data_Value", o_orderkey) AS v
  FROM order_rows GROUP BY ALL)
SELECT o.*, a.v AS lag_1, b.v AS lag_2 FROM order_rows o
LEFT JOIN cells a ON a.o_custkey = o.o_custkey AND a."YearStart" + 1 = o."YearStart"
LEFT JOIN cells b ON b.o_custkey = o.o_custkey AND b."YearStart" + 2 = o."YearStart" """)
def calendar_lags_repeated_keys(spark, sf):
    return panel.calendar_lags(order_rows(spark, sf), ["o_custkey"], tie=["o_orderkey"])


@query(f"""WITH {ORDER_ROWS_SQL}, cells AS (
  SELECT o_custkey, "YearStart", count(*) AS n_rows FROM order_rows GROUP BY ALL)
SELECT c.*, c.n_rows * coalesce(a.n_rows, 1) * coalesce(b.n_rows, 1) AS n_fanned FROM cells c
LEFT JOIN cells a ON a.o_custkey = c.o_custkey AND a."YearStart" + 1 = c."YearStart"
LEFT JOIN cells b ON b.o_custkey = c.o_custkey AND b."YearStart" + 2 = c."YearStart" """)
def lag_fan_out(spark, sf):
    return panel.fan_out_rows(order_rows(spark, sf), ["o_custkey"])


@query(f"""WITH {ORDER_ROWS_SQL}
SELECT o.*, a."Data_Value" AS lag_1, b."Data_Value" AS lag_2 FROM order_rows o
LEFT JOIN order_rows a ON a.o_custkey = o.o_custkey AND a."YearStart" + 1 = o."YearStart"
LEFT JOIN order_rows b ON b.o_custkey = o.o_custkey AND b."YearStart" + 2 = o."YearStart" """)
def lag_join_rows(spark, sf):
    """The fanned rows of a lag join on repeated keys."""
    return panel.lag_join(order_rows(spark, sf), ["o_custkey"])


@query(f"""WITH {LAGGED_SQL}
SELECT unit, "YearStart", lag_1, lag_2, rolling_mean_3, trend_1yr FROM lagged""")
def rolling_mean_and_trend(spark, sf):
    return lagged(spark, sf).select(
        "unit", "YearStart", "lag_1", "lag_2", "rolling_mean_3", "trend_1yr"
    )


@query(f"""WITH {SPARSE_SQL} SELECT unit, "YearStart", {SCALED_SQL.format(t='sparse')} FROM sparse""")
def year_normalized(spark, sf):
    return panel.year_scale(carriers.sparse(spark, sf)).select("unit", "YearStart", "year_normalized")


@query(f"""WITH {SPARSE_SQL} SELECT unit, "YearStart",
  "High_Confidence_Limit" - "Low_Confidence_Limit" AS ci_width FROM sparse""")
def interval_width(spark, sf):
    return panel.ci_width(carriers.sparse(spark, sf)).select("unit", "YearStart", "ci_width")


FEATURES_SQL = f"""{CLEAN_SQL},
featured AS (
  SELECT c."YearStart", c."LocationAbbr", c.stratum_category, c.stratum_value,
    CAST(c."YearStart" - (SELECT min("YearStart") FROM clean) AS DOUBLE)
      / greatest((SELECT max("YearStart") - min("YearStart") FROM clean), 1) AS year_normalized,
    c."LocationAbbr_enc", c.region_enc, c.stratum_category_enc, c.stratum_value_enc,
    c.income_enc, c.education_enc, c.gender_enc,
    a."Data_Value" AS lag_1, b."Data_Value" AS lag_2,
    CASE WHEN a."Data_Value" IS NOT NULL AND b."Data_Value" IS NOT NULL
         THEN (a."Data_Value" + b."Data_Value") / 2
         ELSE coalesce(a."Data_Value", b."Data_Value") END AS rolling_mean_3,
    a."Data_Value" - b."Data_Value" AS trend_1yr,
    c."High_Confidence_Limit" - c."Low_Confidence_Limit" AS ci_width
  FROM clean c
  LEFT JOIN clean a ON a."LocationAbbr" = c."LocationAbbr" AND a."YearStart" + 1 = c."YearStart"
    AND a."StratificationCategory1" = c."StratificationCategory1"
    AND a."Stratification1" = c."Stratification1"
  LEFT JOIN clean b ON b."LocationAbbr" = c."LocationAbbr" AND b."YearStart" + 2 = c."YearStart"
    AND b."StratificationCategory1" = c."StratificationCategory1"
    AND b."Stratification1" = c."Stratification1")"""

FEATURE_NUMBERS = [f for f in panel.FEATURES if f != "YearStart"]


def _filled(c):
    return f'coalesce(CAST("{c}" AS DOUBLE), (SELECT median(CAST("{c}" AS DOUBLE)) FROM featured)) AS "{c}"'


@query(f"WITH {FEATURES_SQL} SELECT * FROM featured")
def feature_matrix(spark, sf):
    return panel.features(clean_panel(spark, sf), SETTINGS, impute=False)


@query(f"""WITH {FEATURES_SQL} SELECT "YearStart", "LocationAbbr", stratum_category, stratum_value,
  {', '.join(_filled(c) for c in FEATURE_NUMBERS)} FROM featured""")
def imputed_features(spark, sf):
    return panel.features(clean_panel(spark, sf), SETTINGS, cut=sinks.table_cut(spark))


@query(f"""WITH {FEATURES_SQL},
n AS (SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE lag_1 IS NULL) + count(*) FILTER (WHERE lag_2 IS NULL)
  + count(*) FILTER (WHERE trend_1yr IS NULL) + count(*) FILTER (WHERE rolling_mean_3 IS NULL) AS n_null
  FROM featured)
SELECT 'non_empty' AS "check", CAST(NULL AS VARCHAR) AS item, CAST(n_rows AS DOUBLE) AS value,
  n_rows > 0 AS passed FROM n
UNION ALL SELECT 'n_features', NULL, 5, NULL FROM n
UNION ALL SELECT 'no_infinities', NULL, 0, true FROM n
UNION ALL SELECT 'null_total', NULL, n_null, NULL FROM n
UNION ALL SELECT 'all_numeric', 'stratum_category', 0, false FROM n
UNION ALL SELECT 'expected_features', 'lag_9', 0, false FROM n""")
def feature_quality_report(spark, sf):
    matrix = panel.features(clean_panel(spark, sf), SETTINGS, impute=False).select(
        "stratum_category", "lag_1", "lag_2", "trend_1yr", "rolling_mean_3"
    )
    return quality.check_features(matrix, expected=["lag_1", "lag_9"])


_MEDIANS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count("{c}") AS n, median(CAST("{c}" AS DOUBLE)) AS median
    FROM sparse""" for c in ("Data_Value", "Low_Confidence_Limit", "High_Confidence_Limit", "n")
)


@query(f"WITH {SPARSE_SQL} SELECT column_name, n, round(median, 6) AS median FROM ({_MEDIANS})")
def column_medians(spark, sf):
    names = ["Data_Value", "Low_Confidence_Limit", "High_Confidence_Limit", "n"]
    out = panel.medians(sparse_table(spark, sf), names)
    return out.withColumn("median", F.round("median", 6))


@query(f"""WITH {SPARSE_SQL} SELECT round(quantile_cont("Data_Value", 0.75), 6) AS high_risk_threshold
FROM sparse WHERE "YearStart" <= {TRAIN_MAX}""")
def risk_threshold(spark, sf):
    out = targets.threshold(sparse_table(spark, sf), 75, F.col("YearStart") <= TRAIN_MAX)
    return out.select(F.round("high_risk_threshold", 6).alias("high_risk_threshold"))


@query(f"""WITH {LABELLED_PANEL_SQL}
SELECT unit, "YearStart", high_risk_obesity, early_warning FROM warned""")
def early_warning_label(spark, sf):
    return warned(spark, sf).select("unit", "YearStart", "high_risk_obesity", "early_warning")


@query(f"""WITH {ORDER_ROWS_SQL}
SELECT *, lead("Data_Value") OVER (PARTITION BY o_custkey ORDER BY "YearStart", o_orderkey) AS following
FROM order_rows""")
def next_observed_repeated_keys(spark, sf):
    return next_in_order(
        order_rows(spark, sf), ["o_custkey"], ["YearStart", "o_orderkey"], "Data_Value", "following"
    )


@query(f"""WITH {ORDER_ROWS_SQL}, flagged AS (
  SELECT *, 1 AS same, CAST("Data_Value" >= 200000 AS INT) AS high FROM order_rows),
following AS (SELECT *, lead(high) OVER (PARTITION BY o_custkey ORDER BY "YearStart", o_orderkey) AS nxt
  FROM flagged)
SELECT * EXCLUDE (nxt), CASE WHEN high = 0 THEN nxt END AS early_warning FROM following""")
def early_warning_repeated_keys(spark, sf):
    """Early warning where a unit has several rows a year, the first part of the order constant."""
    high = (F.col("Data_Value") >= 200000).cast("int")
    rows = order_rows(spark, sf).withColumns({"same": F.lit(1), "high": high})
    return targets.early_warning(rows, ["o_custkey"], "high", tie=["same", "o_orderkey"])


@query(f"""WITH {LABELLED_PANEL_SQL}
SELECT count(early_warning) AS n_labelled,
  count(*) FILTER (WHERE early_warning = 1) AS n_positive,
  count(*) FILTER (WHERE early_warning = 0) AS n_negative,
  round(CAST(count(*) FILTER (WHERE early_warning = 0) AS DOUBLE)
    / greatest(count(*) FILTER (WHERE early_warning = 1), 1), 6) AS imbalance_ratio,
  round(count(*) FILTER (WHERE early_warning = 1) * CAST(100 AS DOUBLE) / count(early_warning), 6)
    AS pct_positive FROM warned""")
def label_balance(spark, sf):
    out = targets.label_counts(warned(spark, sf), "early_warning")
    return out.withColumns({c: F.round(c, 6) for c in ("imbalance_ratio", "pct_positive")})


@query(f"""WITH {CLEAN_SQL},
limits AS (SELECT quantile_cont("Data_Value", 0.75) AS t FROM clean WHERE "YearStart" <= {TRAIN_MAX}),
flagged AS (SELECT *, CAST("Data_Value" >= t AS INTEGER) AS high_risk_obesity FROM clean, limits)
SELECT "YearStart", "LocationAbbr", "LocationDesc", stratum_category, stratum_value, "Data_Value",
  high_risk_obesity, CASE WHEN high_risk_obesity = 0 THEN lead(high_risk_obesity) OVER (
    PARTITION BY "LocationAbbr", "StratificationCategory1", "Stratification1" ORDER BY "YearStart")
  END AS early_warning FROM flagged""")
def target_table(spark, sf):
    base = clean_panel(spark, sf)
    settings = SETTINGS.override(early_warning_min_pairs=1)
    out, _ = targets.build(base, F.col("YearStart") <= TRAIN_MAX, settings, unique=True)
    return targets.target_table(out, settings)


# Collapsing strata below 160 rows makes distinct units share a key.
COLLIDED_SQL = f"""{PREPARED_SQL},
value_rows AS (SELECT stratum_value AS sv, count(*) AS n FROM prepared GROUP BY 1),
collided AS (
  SELECT "YearStart", "LocationAbbr", "LocationDesc", stratum_category,
    CASE WHEN v.n < 160 THEN 'Other' ELSE stratum_value END AS stratum_value,
    "Data_Value", "Low_Confidence_Limit", "High_Confidence_Limit", "Sample_Size",
    "StratificationCategory1", "Stratification1"
  FROM prepared JOIN value_rows v ON stratum_value = v.sv),
firsts AS (
  SELECT *, row_number() OVER (
    PARTITION BY "YearStart", "LocationAbbr", stratum_category, stratum_value
    ORDER BY "StratificationCategory1", "Stratification1") AS f
  FROM collided)"""


@query(f"""WITH {COLLIDED_SQL}
SELECT "YearStart", "LocationAbbr", stratum_category, stratum_value, "StratificationCategory1",
  "Stratification1", "Low_Confidence_Limit", "High_Confidence_Limit", "Sample_Size", "LocationDesc", "Data_Value"
FROM firsts WHERE f = 1""")
def feature_target_join(spark, sf):
    base = encode.collapse_rare(prepared(spark, sf), "stratum_value", min_rows=160)
    keys = ["YearStart", "LocationAbbr", "stratum_category", "stratum_value"]
    unit = ["StratificationCategory1", "Stratification1"]
    left = base.select(*keys, *unit, "Low_Confidence_Limit", "High_Confidence_Limit", "Sample_Size")
    return targets.join_targets(left, base.select(*keys, *unit, "LocationDesc", "Data_Value"), keys)


@query(f"""WITH {SPARSE_SQL} SELECT {SPLIT_SQL} AS split, count(*) AS n,
  min("YearStart") AS first_year, max("YearStart") AS last_year FROM sparse GROUP BY 1""")
def temporal_split(spark, sf):
    base = carriers.sparse(spark, sf)
    return (
        base.withColumn("split", targets.split_name(F.col("YearStart"), SETTINGS))
        .groupBy("split")
        .agg(
            F.count("*").alias("n"),
            F.min("YearStart").alias("first_year"),
            F.max("YearStart").alias("last_year"),
        )
    )


WINDOWS_SQL = f"""{SPARSE_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY "YearStart") AS r FROM sparse),
windows AS (
  SELECT d.unit, d."YearStart" AS target_year,
    [[a."Data_Value", CAST(a.n AS DOUBLE)], [b."Data_Value", CAST(b.n AS DOUBLE)],
     [c."Data_Value", CAST(c.n AS DOUBLE)]] AS features,
    d."Data_Value" AS target
  FROM numbered d JOIN numbered c ON c.unit = d.unit AND c.r = d.r - 1
  JOIN numbered b ON b.unit = d.unit AND b.r = d.r - 2
  JOIN numbered a ON a.unit = d.unit AND a.r = d.r - 3)"""


def windows(spark, sf):
    return panel.sequences(
        carriers.sparse(spark, sf), ["Data_Value", "n"], length=3, unit=["unit"]
    )


_STEPS = ", ".join(
    f"features[{t + 1}][{i + 1}] AS x_{t}_{i}" for t in range(3) for i in range(2)
)


@query(f"WITH {WINDOWS_SQL} SELECT unit, target_year, target, {_STEPS} FROM windows")
def sequence_windows(spark, sf):
    flat, _ = sequence.flatten(windows(spark, sf), length=3, n_features=2)
    return flat


@query(f"""WITH {WINDOWS_SQL} SELECT CASE WHEN target_year <= {TRAIN_MAX} THEN 'train'
  WHEN target_year <= {VAL_MAX} THEN 'val' ELSE 'test' END AS split, count(*) AS n
FROM windows GROUP BY 1""")
def sequence_split(spark, sf):
    split = targets.sequence_split_name(F.col("target_year"), SETTINGS)
    return windows(spark, sf).groupBy(split.alias("split")).agg(F.count("*").alias("n"))


@query(f"""WITH {LABELLED_PANEL_SQL} SELECT unit, "YearStart", early_warning FROM warned
WHERE early_warning IS NOT NULL""")
def labelled_rows_only(spark, sf):
    out = warned(spark, sf).where(F.col("early_warning").isNotNull())
    return out.select("unit", "YearStart", "early_warning")


@query(f"""WITH {EXTRACT_SQL} SELECT * FROM extract
WHERE "YearStart" = (SELECT max("YearStart") FROM extract)""")
def latest_year_rows(spark, sf):
    return eda.latest_year(encode.coerce_numbers(carriers.extract(spark, sf)))


@query(f"""WITH {SPARSE_SQL} SELECT "YearStart", count(*) AS n, min("Data_Value") AS low,
  max("Data_Value") AS high FROM sparse GROUP BY 1""")
def written_table_rescan(spark, sf):
    """A stage table written partitioned by year and read back with its types."""
    folder = sinks.table_folder(spark)
    back = sinks.write_table(carriers.sparse(spark, sf), f"{folder}/sparse.parquet", "YearStart")
    return back.groupBy("YearStart").agg(
        F.count("*").alias("n"),
        F.min("Data_Value").alias("low"),
        F.max("Data_Value").alias("high"),
    )


@query(f"""WITH {LABELLED_PANEL_SQL}
SELECT round(any_value(t), 6) AS high_risk_threshold, CAST(75 AS INTEGER) AS high_risk_percentile,
  count(early_warning) >= 100 AS early_warning_built, count(*) AS n_total_rows,
  CAST(sum(coalesce(high_risk_obesity, 0)) AS BIGINT) AS n_high_risk,
  CASE WHEN count(early_warning) >= 100 THEN 'early_warning' ELSE 'high_risk_obesity' END AS target
FROM warned, limits""")
def target_metadata(spark, sf):
    """What building the targets learned, and the classification target it leads to."""
    base = sparse_table(spark, sf)
    settings = SETTINGS.override(unit_key=("unit",), early_warning_min_pairs=100)
    _, found = targets.build(base, F.col("YearStart") <= TRAIN_MAX, settings, unique=True)
    return found.as_frame(spark).select(
        F.round("high_risk_threshold", 6).alias("high_risk_threshold"),
        F.col("high_risk_percentile").cast("int").alias("high_risk_percentile"),
        "early_warning_built", "n_total_rows", "n_high_risk",
        F.lit(targets.choose(found, settings)).alias("target"),
    )
