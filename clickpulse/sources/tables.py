"""Table scans (S1). Column pruning and filter pushdown are Catalyst's: callers
select the columns they need and the parquet scan's ``ReadSchema`` follows.

Known tables are read with an explicit schema, so no job has to open file
footers to infer one (at scale, thousands of footers on the driver).
"""

from __future__ import annotations

import os

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickpulse.schemas import CITIES, PRODUCTS, USERS, VISITS, assert_schema

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Input schemas of the tables the adapters read (DDL strings).
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, where: str, name: str) -> DataFrame:
    """Read table ``name`` from a directory of ``<name>.parquet`` files (or
    folders), or, when ``where`` is ``"catalog"``, from the session catalog."""
    if where == "catalog":
        return spark.table(name)
    path = os.path.join(where, f"{name}.parquet")
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(path)


#: The names of the four tables of a click log as its producers write them.
CLICK_LOG = {"visits": "user_visit_action", "users": "user_info", "products": "product_info", "cities": "city_info"}


@dataclass
class ClickLogTables:
    """A click log under its own table names, in a folder of ``<name>.parquet`` or in the
    catalog (``where="catalog"``). Columns and types are checked when a table is opened;
    ``event_id``, an explicit order of visits in the same second, may be missing."""

    spark: SparkSession
    where: str

    def _table(self, name: str, schema, optional: tuple[str, ...] = ()) -> DataFrame:
        df = read_table(self.spark, self.where, CLICK_LOG[name])
        wanted = type(schema)([f for f in schema.fields if f.name not in optional or f.name in df.columns])
        return assert_schema(df, wanted)

    def visits(self, params: dict | None = None) -> DataFrame:
        return self._table("visits", VISITS, ("event_id",))

    def users(self) -> DataFrame:
        return self._table("users", USERS)

    def products(self) -> DataFrame:
        return self._table("products", PRODUCTS)

    def cities(self) -> DataFrame:
        return self._table("cities", CITIES)
