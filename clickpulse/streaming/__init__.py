"""Structured Streaming wiring of the ad-click analyses (Q5-Q8)."""

from clickpulse.streaming.ad_stream import AdStreamJob, start_ad_stream
from clickpulse.streaming.aggregations import (
    decoded_click_stream, day_area_city_ad_counts_stream, ad_window_counts_stream,
)

__all__ = ["AdStreamJob", "start_ad_stream", "decoded_click_stream",
           "day_area_city_ad_counts_stream", "ad_window_counts_stream"]
