"""Schemas of the data model (the reference's tables, re-typed) and a schema check.

Row conventions kept from the reference: a visit row carries one action;
"not a click" is -1 in the click columns, "not an order / pay / search" is null;
``date`` is ``yyyy-MM-dd`` text and ``action_time`` ``yyyy-MM-dd HH:mm:ss`` text,
so both compare correctly as strings. ``event_id`` is the explicit tie-break
for actions in the same second (defect D18).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

VISITS = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITIES = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

# Decoded ad-click record. The wire format is the CSV line
# ``timestamp,area,city,userid,adid`` (epoch ms first, the rest text).
AD_CLICKS = T.StructType([
    T.StructField("ts", T.LongType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("userid", T.StringType()),
    T.StructField("adid", T.StringType()),
])

AD_LINE_FIELDS = [f.name for f in AD_CLICKS.fields]


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, schema: T.StructType, exact: bool = False) -> DataFrame:
    """Check once, by name and type, that ``df`` carries ``schema``'s columns.

    Returns ``df`` projected to the schema's column order, so downstream code
    sees a stable layout. ``exact`` also rejects extra columns.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"column {f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if exact:
        extra = set(have) - {f.name for f in schema.fields}
        if extra:
            problems.append(f"unexpected columns {sorted(extra)}")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*[f.name for f in schema.fields])
