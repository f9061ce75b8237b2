"""Ingest, cleaning, encoding and data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratline.functions import lookups, parsing
from stratline.operators import eda, encode, metrics, quality, rows
from stratline.plans import carriers
from stratline.plans.carriers import EXTRACT_SQL, SETTINGS, table
from stratline.plans.registry import query
from stratline.settings import TARGET_CLASS, TARGET_QUESTION
from stratline.sources import ingest, sinks

INDICATOR_SQL = f"""{EXTRACT_SQL},
indicator AS (
  SELECT * FROM extract WHERE "Class" = '{TARGET_CLASS}' AND "Question" = '{TARGET_QUESTION}')"""

_REGIONS = ", ".join(f"('{code}', '{region}')" for code, region in lookups.REGION_OF.items())
PREPARED_SQL = f"""{INDICATOR_SQL},
region_of(code, region) AS (VALUES {_REGIONS}),
prepared AS (
  SELECT DISTINCT i.*, trim("StratificationCategory1") AS stratum_category,
         trim("Stratification1") AS stratum_value, coalesce(r.region, 'Unknown') AS region
  FROM indicator i LEFT JOIN region_of r ON i."LocationAbbr" = r.code
  WHERE "Data_Value" IS NOT NULL)"""


def _levels(column: str, table: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items())
    return f"CAST(CASE {column} {arms} END AS INTEGER)"


ORDINALS_SQL = f"""
  {_levels('"Income"', lookups.INCOME_CODE)} AS income_enc,
  {_levels('"Education"', lookups.EDUCATION_CODE)} AS education_enc,
  {_levels('"Sex"', lookups.SEX_CODE)} AS gender_enc"""

CODES_SQL = ", ".join(
    f'CAST(dense_rank() OVER (ORDER BY "{c}") - 1 AS INTEGER) AS "{c}_enc"'
    for c in encode.ENCODED
)
CLEAN_SQL = f"""{PREPARED_SQL},
value_rows AS (SELECT stratum_value AS sv, count(*) AS n FROM prepared GROUP BY 1),
collapsed AS (
  SELECT p.* REPLACE (CASE WHEN v.n < {SETTINGS.min_stratum_rows} THEN 'Other' ELSE stratum_value END
                      AS stratum_value)
  FROM prepared p LEFT JOIN value_rows v ON p.stratum_value = v.sv),
clean AS (SELECT *, {CODES_SQL}, {ORDINALS_SQL} FROM collapsed)"""


def indicator(spark: SparkSession, sf: str) -> DataFrame:
    raw = carriers.extract(spark, sf)
    return ingest.select_indicator(raw, TARGET_CLASS, TARGET_QUESTION)


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return encode.prepare(indicator(spark, sf), SETTINGS)


def prepared_table(spark: SparkSession, sf: str) -> DataFrame:
    """prepared(), written once for queries that read it several times."""
    return sinks.table_cut(spark)(prepared(spark, sf), "prepared")


def clean_panel(spark: SparkSession, sf: str) -> DataFrame:
    cut = sinks.table_cut(spark)
    return cut(encode.clean(indicator(spark, sf), SETTINGS, cut), "clean")


MESSY_SQL = """
messy AS (
  SELECT event_id, event_type, value, CASE event_type
    WHEN 'view' THEN NULL WHEN 'signup' THEN NULL WHEN 'purchase' THEN NULL ELSE value END AS number
  FROM events)"""


def messy_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event values as texts: plain, padded, with a Java suffix, with a comma, and missing."""
    value = F.col("value").cast("string")
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.when(kind == "view", F.concat(value, F.lit("d")))
        .when(kind == "signup", "N/A")
        .when(kind == "purchase", F.concat(F.lit("1,"), value))
        .when(kind == "click", F.concat(F.lit(" "), value, F.lit("\t")))
        .otherwise(value)
        .alias("text"),
    )


@query("SELECT o_orderkey, o_totalprice, o_custkey FROM orders")
def lenient_projection(spark, sf):
    orders = table(spark, sf, "orders")
    return rows.project_present(orders, ["o_orderkey", "no_such_column", "o_totalprice", "o_custkey"])


@query(f"""WITH {EXTRACT_SQL} SELECT min("YearStart") AS year_min, max("YearStart") AS year_max,
  count(DISTINCT "LocationAbbr") AS n_locations FROM extract""")
def load_summary(spark, sf):
    return ingest.load_summary(carriers.extract(spark, sf))


@query(f"WITH {INDICATOR_SQL} SELECT * FROM indicator")
def indicator_filter(spark, sf):
    return encode.coerce_numbers(indicator(spark, sf))


@query(f"""WITH {INDICATOR_SQL} SELECT * FROM indicator WHERE "Data_Value" IS NOT NULL""")
def drop_missing_target(spark, sf):
    return encode.coerce_numbers(indicator(spark, sf)).na.drop(subset=["Data_Value"])


@query(f"WITH {MESSY_SQL} SELECT event_id, event_type, number FROM messy")
def numeric_cast(spark, sf):
    messy = messy_events(spark, sf)
    return messy.select("event_id", "event_type", parsing.to_double(messy, "text").alias("number"))


@query("""SELECT event_id, CASE WHEN event_type <> 'signup' THEN event_type END AS kept,
  CASE WHEN value = floor(value) THEN CAST(value AS INTEGER) END AS whole FROM events""")
def na_tokens_and_integers(spark, sf):
    events = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "signup", "N/A").otherwise(F.col("event_type"))
    return events.select(
        "event_id", parsing.na_to_null(text).alias("kept"), parsing.to_year(events, "value").alias("whole")
    )


@query(f"""WITH {EXTRACT_SQL} SELECT "YearStart", "LocationAbbr", "Class",
  coalesce(trim("StratificationCategory1"), 'Total') AS stratum_category,
  coalesce(trim("Sex"), 'Total') AS stratum_value FROM extract""")
def trim_and_default(spark, sf):
    raw = carriers.extract(spark, sf).withColumn("Stratification1", F.col("Sex"))
    return encode.standard_strata(encode.coerce_numbers(raw)).select(
        "YearStart", "LocationAbbr", "Class", "stratum_category", "stratum_value"
    )


@query(f"WITH {PREPARED_SQL} SELECT region, \"LocationAbbr\", count(*) AS n FROM prepared GROUP BY ALL")
def region_lookup(spark, sf):
    return prepared(spark, sf).groupBy("region", "LocationAbbr").agg(F.count("*").alias("n"))


@query(f"WITH {PREPARED_SQL} SELECT * FROM prepared")
def prepared_rows(spark, sf):
    return prepared(spark, sf)


@query(f"WITH {CLEAN_SQL} SELECT * FROM clean")
def cleaned_panel(spark, sf):
    return clean_panel(spark, sf)


@query("""WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)
SELECT CASE WHEN c.n < 80 THEN 'Other' ELSE p_brand END AS p_brand, p_partkey
FROM part JOIN c USING (p_brand)""")
def rare_value_collapse(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return encode.collapse_rare(part, "p_brand", min_rows=80)


@query("""SELECT p_partkey, p_brand, p_name,
  CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_enc,
  CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS p_name_enc FROM part""")
def label_encoding(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    return encode.label_encode(part, ["p_brand", "p_name"])


@query(f"""WITH {EXTRACT_SQL} SELECT "LocationAbbr", "YearStart", "Class", "Stratification1",
  {ORDINALS_SQL} FROM extract""")
def ordinal_maps(spark, sf):
    raw = encode.ordinals(encode.coerce_numbers(carriers.extract(spark, sf)))
    return raw.select(
        "LocationAbbr", "YearStart", "Class", "Stratification1",
        "income_enc", "education_enc", "gender_enc",
    )


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, sf):
    return rows.count_by(table(spark, sf, "orders"), "o_orderpriority")


@query(f"WITH {EXTRACT_SQL} SELECT DISTINCT * FROM extract")
def distinct_rows(spark, sf):
    return rows.distinct_rows(encode.coerce_numbers(carriers.extract(spark, sf)))


@query(f"""WITH {EXTRACT_SQL}, d AS (SELECT DISTINCT * FROM extract)
SELECT (SELECT count(*) FROM extract) AS n_rows, (SELECT count(*) FROM d) AS n_distinct,
  (SELECT count(*) FROM extract) - (SELECT count(*) FROM d) AS n_duplicates""")
def duplicate_rows(spark, sf):
    return rows.duplicate_count(carriers.extract(spark, sf))


@query("""SELECT * EXCLUDE (rn) FROM (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y,
    strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey, o_totalprice,
    row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def keep_first_per_key(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey",
        F.year("o_orderdate").alias("y"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        "o_orderkey",
        "o_totalprice",
    )
    return rows.keep_first(orders, ["o_custkey", "y"], order=["day", "o_orderkey"])


def _profile(names):
    arms = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE "{c}" IS NULL) AS null_count,
        count(*) AS n_rows FROM extract""" for c in names
    )
    return f"""profile AS (
  SELECT *, CAST(null_count AS DOUBLE) / n_rows AS null_fraction,
    round(CAST(null_count AS DOUBLE) / n_rows * 100, 1) AS null_pct FROM ({arms}))"""


EXTRACT_COLUMNS = [
    "YearStart", "LocationAbbr", "LocationDesc", "Class", "Topic", "Question", "Data_Value",
    "Low_Confidence_Limit", "High_Confidence_Limit", "Sample_Size", "Total", "Education", "Sex",
    "Income", "StratificationCategory1", "Stratification1",
]
PROFILE_SQL = f"{EXTRACT_SQL}, {_profile(EXTRACT_COLUMNS)}"


@query(f"WITH {PROFILE_SQL} SELECT * FROM profile")
def null_profile(spark, sf):
    return rows.null_profile(encode.coerce_numbers(carriers.extract(spark, sf)))


_SPARSE = ", ".join(f"'{c}'" for c in quality.SPARSE)
MISSING_SQL = f"""{PROFILE_SQL},
missing AS (SELECT *, column_name NOT IN ({_SPARSE}) AND null_pct > 80 AS flagged,
  column_name IN ({_SPARSE}) AND null_pct > 50 AS expected FROM profile WHERE null_count > 0)"""


@query(f"WITH {MISSING_SQL} SELECT * FROM missing")
def missingness(spark, sf):
    return quality.missingness(encode.coerce_numbers(carriers.extract(spark, sf)))


@query(f"""WITH {EXTRACT_SQL} SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE "Data_Value" IS NULL) AS n_unparseable,
  count(*) FILTER (WHERE "Data_Value" < 0 OR "Data_Value" > 100) AS n_out_of_range,
  CAST(min("YearStart") AS DOUBLE) AS year_min, CAST(max("YearStart") AS DOUBLE) AS year_max
FROM extract""")
def unparseable_and_ranges(spark, sf):
    return quality.value_counts_check(carriers.extract(spark, sf))


@query(f"""WITH {MISSING_SQL}, d AS (SELECT DISTINCT * FROM extract),
surplus AS (SELECT (SELECT count(*) FROM extract) - (SELECT count(*) FROM d) AS n)
SELECT 'required_columns' AS "check", CAST(NULL AS VARCHAR) AS item, CAST(5 AS DOUBLE) AS value,
  true AS passed
UNION ALL SELECT 'data_value_numeric', NULL, 0.0, true
UNION ALL SELECT 'data_value_range', NULL,
  CAST((SELECT count(*) FROM extract WHERE "Data_Value" < 0 OR "Data_Value" > 100) AS DOUBLE),
  NOT EXISTS (SELECT 1 FROM extract WHERE "Data_Value" < 0 OR "Data_Value" > 100)
UNION ALL SELECT 'year_range', 'min', min("YearStart"),
  min("YearStart") >= 2000 AND max("YearStart") <= 2030 FROM extract
UNION ALL SELECT 'year_range', 'max', max("YearStart"),
  min("YearStart") >= 2000 AND max("YearStart") <= 2030 FROM extract
UNION ALL SELECT 'missingness', column_name, null_count, NOT flagged FROM missing
UNION ALL SELECT 'duplicates', NULL, n, n = 0 FROM surplus""")
def raw_quality_report(spark, sf):
    return quality.check_raw(encode.coerce_numbers(carriers.extract(spark, sf)))


@query("""SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)licen')
  OR regexp_matches(lang, '(?i)licen') OR regexp_matches(source, '(?i)licen')""")
def any_text_search(spark, sf):
    documents = table(spark, sf, "documents")
    return documents.where(eda.any_text_matches(documents, "licen")).select("doc_id")


@query(f"""WITH {EXTRACT_SQL} SELECT * FROM extract
WHERE contains(lower("Topic"), 'obesity') AND "Question" = '{TARGET_QUESTION}'""")
def topic_text_filter(spark, sf):
    raw = encode.coerce_numbers(carriers.extract(spark, sf))
    return raw.where(
        eda.text_contains(F.col("Topic"), "Obesity") & (F.col("Question") == TARGET_QUESTION)
    )


def _few(tab, names):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(DISTINCT "{c}") AS n_distinct,
        array_to_string(list_slice(list_sort(list(DISTINCT "{c}")
          FILTER (WHERE "{c}" IS NOT NULL)), 1, 10), '; ') AS first_values FROM {tab}""" for c in names
    )


@query(f"""SELECT * FROM ({_few('part', ['p_name', 'p_brand', 'p_type'])})
WHERE n_distinct > 1 AND n_distinct < 50""")
def low_cardinality_columns(spark, sf):
    few = eda.low_cardinality(table(spark, sf, "part"))
    return few.withColumn("first_values", F.array_join("first_values", "; "))


@query("SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem")
def table_shape(spark, sf):
    return eda.column_shape(table(spark, sf, "lineitem"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


# --- text files -------------------------------------------------------------------------


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment,
  CASE WHEN c_custkey % 3 = 0 THEN c_name || chr(10) || '"' || c_mktsegment || '", ' || c_nationkey
    WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS note FROM customer""")
def csv_quoted_lines(spark, sf):
    """Written as CSV and read again: cells with quotes, commas and line breaks, missing-value
    tokens, a header name with a blank."""
    key, name = F.col("c_custkey"), F.col("c_name")
    quoted = F.concat(name, F.lit('\n"'), "c_mktsegment", F.lit('", '), F.col("c_nationkey").cast("string"))
    note = F.when(key % 3 == 0, quoted).when(key % 7 == 0, "N/A").otherwise(name)
    rows = table(spark, sf, "customer").select(
        key.alias("id"), F.col("c_mktsegment").alias("segment"), note.alias("note ")
    )
    path = f"{sinks.table_folder(spark)}/customers.csv"
    sinks.write_csv(rows, path)
    return ingest.read_csv(spark, path)


@query("""SELECT 'regression' AS track, c_mktsegment AS model, 'val' AS split, m.metric,
  CASE m.metric WHEN 'mean' THEN round(avg(c_acctbal), 4) ELSE max(c_acctbal) END AS value
  FROM customer, (VALUES ('mean'), ('max')) m(metric) GROUP BY c_mktsegment, m.metric""")
def metrics_written_and_read(spark, sf):
    """Long metrics through the metrics sink."""
    wide = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("model")).agg(
        F.round(F.avg("c_acctbal"), 4).alias("mean"), F.max("c_acctbal").alias("max")
    )
    long = metrics.to_long(wide, ["model"], ["mean", "max"])
    path = f"{sinks.table_folder(spark)}/metrics"
    sinks.write_metrics(long.select(F.lit("regression").alias("track"), "model", F.lit("val").alias("split"), "metric", "value"), path)
    return sinks.read_metrics(spark, path)
