"""Fixed dimension tables and literal-map lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Census region of each location code.
REGIONS = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "South": [
        "DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV",
        "AL", "KY", "MS", "TN", "AR", "LA", "OK", "TX",
    ],
    "West": ["AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"],
    "Territory": ["PR", "GU", "VI", "AS", "MP"],
    "National": ["US"],
}

# Ordered survey answers. As features, "Data not reported" is the top level.
INCOME_LEVELS = [
    "Less than $15,000",
    "$15,000 - $24,999",
    "$25,000 - $34,999",
    "$35,000 - $49,999",
    "$50,000 - $74,999",
    "$75,000 or greater",
    "Data not reported",
]
EDUCATION_LEVELS = [
    "Less than high school",
    "High school graduate",
    "Some college or technical school",
    "College graduate",
    "Data not reported",
]
SEX_LEVELS = ["Male", "Female"]

REGION_OF = {code: region for region, codes in REGIONS.items() for code in codes}
INCOME_CODE = {text: i for i, text in enumerate(INCOME_LEVELS)}
EDUCATION_CODE = {text: i for i, text in enumerate(EDUCATION_LEVELS)}
SEX_CODE = {text: i for i, text in enumerate(SEX_LEVELS)}

# In the hypothesis tests the levels count from 1 and "Data not reported" is missing.
INCOME_RANK = {text: i + 1 for i, text in enumerate(INCOME_LEVELS[:-1])}
EDUCATION_RANK = {text: i + 1 for i, text in enumerate(EDUCATION_LEVELS[:-1])}


def lookup(col: Column, table: dict) -> Column:
    """Value of `col` in a small literal table, NULL when it is not there."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(literal, col)


def region_of(col: Column) -> Column:
    return F.coalesce(lookup(col, REGION_OF), F.lit("Unknown"))
