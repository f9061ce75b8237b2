"""How star-schema tables stand in for a survey panel.

extract: orders of a nation in a year, broken down by total, market segment, priority and
status, become a raw survey extract (all columns text). The measured value is the share of
orders at or above a price, in percent with one decimal; cells with few orders are
suppressed, as small samples are in a survey.
sparse: one panel unit per customer, with gaps between the years.

Orders are reduced per customer before the customer join, so a customer with very many
orders weighs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratline.functions.lookups import lookup
from stratline.settings import TARGET_CLASS, TARGET_QUESTION, Settings

SETTINGS = Settings().override(
    train_max_year=1998, val_min_year=1999, val_max_year=1999, test_min_year=2000
)

LOCATION_CODES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL",
    "IN", "IA", "KS", "PR", "GU", "US", "ZZ", "MA", "MI", "MN", "NY", "TX",
]
LOCATION_OF = dict(enumerate(LOCATION_CODES))
EDUCATION_OF = {
    "AUTOMOBILE": "Less than high school",
    "BUILDING": "High school graduate",
    "FURNITURE": "Some college or technical school",
    "HOUSEHOLD": "College graduate",
    "MACHINERY": "Data not reported",
}
INCOME_OF = {
    "1-URGENT": "Less than $15,000",
    "2-HIGH": "$15,000 - $24,999",
    "3-MEDIUM": "$35,000 - $49,999",
    "4-NOT SPECIFIED": "Data not reported",
    "5-LOW": "$75,000 or greater",
}
SEX_OF = {"O": "Male", "F": "Female", "P": "Not stated"}

# (class, topic, question, price from which an order counts)
INDICATORS = [
    (TARGET_CLASS, "Obesity / Weight Status", TARGET_QUESTION, 350000),
    ("Physical Activity", "Physical Activity - Behavior", "Percent of adults who are inactive", 250000),
]
MIN_ORDERS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by location, year, education, income and sex, with one count per indicator."""
    orders = table(spark, sf_dir, "orders")
    per_customer = orders.groupBy(
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        "o_orderpriority",
        "o_orderstatus",
    ).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(F.col("o_totalprice") >= price).alias(f"hit_{i}")
            for i, (*_, price) in enumerate(INDICATORS)
        ],
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            lookup(F.col("n_nationkey"), LOCATION_OF).alias("code"),
            F.col("n_name").alias("name"),
            "year",
            lookup(F.col("c_mktsegment"), EDUCATION_OF).alias("education"),
            lookup(F.col("o_orderpriority"), INCOME_OF).alias("income"),
            lookup(F.col("o_orderstatus"), SEX_OF).alias("sex"),
        )
        .agg(F.sum("n").alias("n"), *[F.sum(f"hit_{i}").alias(f"hit_{i}") for i in range(len(INDICATORS))])
    )


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw survey extract with two indicators; every column is text."""
    counts = order_counts(spark, sf_dir)
    strata = F.array(
        F.struct(F.lit("Total").alias("cat"), F.lit("Total").alias("val")),
        F.struct(F.lit("Education").alias("cat"), F.col("education").alias("val")),
        F.struct(F.lit("Income").alias("cat"), F.col("income").alias("val")),
        F.struct(F.lit("Sex ").alias("cat"), F.col("sex").alias("val")),
    )
    indicators = F.array(
        *[
            F.struct(
                F.lit(c).alias("cls"), F.lit(t).alias("topic"), F.lit(q).alias("question"),
                F.col(f"hit_{i}").alias("hit"),
            )
            for i, (c, t, q, _) in enumerate(INDICATORS)
        ]
    )
    cells = (
        counts.select("code", "name", "year", "n", F.explode(strata).alias("s"), indicators.alias("i"))
        .select("code", "name", "year", "n", "s.*", F.explode("i").alias("i"))
        .groupBy("code", "name", "year", "cat", "val", "i.cls", "i.topic", "i.question")
        .agg(F.sum("n").alias("n"), F.sum("i.hit").alias("hit"))
    )
    value = F.expr("(1000 * hit) div n") / F.lit(10.0)
    share = F.col("v") / F.lit(100.0)
    half = F.lit(196.0) * F.sqrt(share * (F.lit(1.0) - share) / F.col("n"))
    shown = F.col("n") >= MIN_ORDERS

    def stratum(name):
        return F.when(F.col("cat") == name, F.col("val"))

    def limit(number):
        text = (F.floor(number * F.lit(10.0)) / F.lit(10.0)).cast("string")
        return F.when(shown, text).otherwise("NA")

    # The first year's totals come twice, as exact copies.
    copies = F.when((F.col("cat") == "Total") & (F.col("year") == 1995), 2).otherwise(1)
    return (
        cells.withColumn("v", value)
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies)))
        .select(
            F.col("year").cast("string").alias("YearStart"),
            F.col("code").alias("LocationAbbr"),
            F.col("name").alias("LocationDesc"),
            F.col("cls").alias("Class"),
            F.col("topic").alias("Topic"),
            F.col("question").alias("Question"),
            F.when(shown, F.col("v").cast("string")).otherwise("~").alias("Data_Value"),
            limit(F.col("v") - half).alias("Low_Confidence_Limit"),
            limit(F.col("v") + half).alias("High_Confidence_Limit"),
            F.col("n").cast("string").alias("Sample_Size"),
            stratum("Total").alias("Total"),
            stratum("Education").alias("Education"),
            stratum("Sex ").alias("Sex"),
            stratum("Income").alias("Income"),
            F.col("cat").alias("StratificationCategory1"),
            F.col("val").alias("Stratification1"),
        )
    )


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and year: mean order price (in cents, cut), price limits, orders."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    year = F.year("o_orderdate").alias("YearStart")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("unit"), year)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(cents).alias("cents"),
            F.min("o_totalprice").alias("lo"),
            F.max("o_totalprice").alias("hi"),
        )
        .select(
            "unit",
            "YearStart",
            (F.expr("cents div n") / F.lit(100.0)).alias("Data_Value"),
            F.when(F.col("n") > 1, F.col("lo")).alias("Low_Confidence_Limit"),
            F.when(F.col("n") > 1, F.col("hi")).alias("High_Confidence_Limit"),
            "n",
        )
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, y (quality), the text length as score, and a 0/1 prediction from it."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    return labels.join(documents, "doc_id").select(
        "doc_id",
        "lang",
        F.col("quality").alias("y"),
        F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") >= 1000).cast("int").alias("prediction"),
        "toxic",
    )


# The same carriers as common table expressions.


def _values(table: dict) -> str:
    def text(v):
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    return ", ".join(f"({text(k)}, {text(v)})" for k, v in table.items())


def _case(column: str, table: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {column} {arms} END"


_INDICATORS = ", ".join(f"('{c}', '{t}', '{q}', {p})" for c, t, q, p in INDICATORS)

EXTRACT_SQL = f"""
loc(k, code) AS (VALUES {_values(LOCATION_OF)}),
base AS (
  SELECT code, n_name AS name, CAST(year(o_orderdate) AS INTEGER) AS y, o_totalprice AS price,
         {_case('c_mktsegment', EDUCATION_OF)} AS education,
         {_case('o_orderpriority', INCOME_OF)} AS income,
         {_case('o_orderstatus', SEX_OF)} AS sex
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN loc ON n_nationkey = k),
strata AS (
  SELECT code, name, y, price, 'Total' AS cat, 'Total' AS val FROM base
  UNION ALL SELECT code, name, y, price, 'Education', education FROM base
  UNION ALL SELECT code, name, y, price, 'Income', income FROM base
  UNION ALL SELECT code, name, y, price, 'Sex ', sex FROM base),
cells AS (
  SELECT code, name, y, cat, val, cls, topic, question, count(*) AS n,
         count(*) FILTER (WHERE price >= lim) AS hit
  FROM strata CROSS JOIN (VALUES {_INDICATORS}) AS i(cls, topic, question, lim)
  GROUP BY ALL),
measured AS (
  SELECT *, CAST((1000 * hit) // n AS DOUBLE) / CAST(10 AS DOUBLE) AS v FROM cells),
ranged AS (
  SELECT *, CAST(196 AS DOUBLE) * sqrt((v / CAST(100 AS DOUBLE))
         * (CAST(1 AS DOUBLE) - v / CAST(100 AS DOUBLE)) / n) AS half FROM measured),
extract AS (
  SELECT y AS "YearStart", code AS "LocationAbbr", name AS "LocationDesc",
    cls AS "Class", topic AS "Topic", question AS "Question",
    CASE WHEN n >= {MIN_ORDERS} THEN v END AS "Data_Value",
    CASE WHEN n >= {MIN_ORDERS} THEN floor((v - half) * CAST(10 AS DOUBLE)) / CAST(10 AS DOUBLE) END
      AS "Low_Confidence_Limit",
    CASE WHEN n >= {MIN_ORDERS} THEN floor((v + half) * CAST(10 AS DOUBLE)) / CAST(10 AS DOUBLE) END
      AS "High_Confidence_Limit",
    CAST(n AS DOUBLE) AS "Sample_Size",
    CASE WHEN cat = 'Total' THEN val END AS "Total",
    CASE WHEN cat = 'Education' THEN val END AS "Education",
    CASE WHEN cat = 'Sex ' THEN val END AS "Sex",
    CASE WHEN cat = 'Income' THEN val END AS "Income",
    cat AS "StratificationCategory1", val AS "Stratification1"
  FROM ranged
  CROSS JOIN generate_series(1, 2) AS g(copy)
  WHERE copy = 1 OR (cat = 'Total' AND y = 1995))"""

SPARSE_SQL = """
sparse AS (
  SELECT o_custkey AS unit, CAST(year(o_orderdate) AS INTEGER) AS "YearStart",
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS DOUBLE) / CAST(100 AS DOUBLE)
      AS "Data_Value",
    CASE WHEN count(*) > 1 THEN min(o_totalprice) END AS "Low_Confidence_Limit",
    CASE WHEN count(*) > 1 THEN max(o_totalprice) END AS "High_Confidence_Limit",
    count(*) AS n
  FROM orders GROUP BY 1, 2)"""

LABELLED_SQL = """
labelled AS (
  SELECT doc_id, lang, quality AS y, CAST(n_chars AS DOUBLE) AS score,
         CAST(n_chars >= 1000 AS INTEGER) AS prediction, toxic
  FROM labels JOIN documents USING (doc_id))"""
