"""Readers: parquet/catalog tables, adapters from the test tables, the ad-log wire format."""

from clickpulse.sources.tables import read_table, TABLES
from clickpulse.sources.adapters import (
    visits_from_events, users_from_customer, cities_from_nation, products_from_part,
    clicks_from_events, click_counts_from_lineitem, AdapterTables,
)
from clickpulse.sources.adlog import encode_ad_log, decode_ad_log, read_ad_lines, read_ad_stream

__all__ = [
    "read_table", "TABLES", "visits_from_events", "users_from_customer", "cities_from_nation",
    "products_from_part", "clicks_from_events", "click_counts_from_lineitem", "AdapterTables",
    "encode_ad_log", "decode_ad_log", "read_ad_lines", "read_ad_stream",
]
