"""The analyses Q0-Q8 and their building blocks, as DataFrame -> DataFrame functions."""

from clickpulse.operators.visits import filtered_visits
from clickpulse.operators.categories import (
    category_actions, category_action_counts, category_top10, category_session_counts,
    category_session_top10, unreadable_category_ids,
)
from clickpulse.operators.paths import (
    page_views, session_jumps, page_transitions, target_flow_pairs, page_jump_ratio,
)
from clickpulse.operators.geo import (
    click_geo, click_geo_counts, area_product_counts, area_product_rank, city_click_ratio,
    area_product_top3,
)
from clickpulse.operators.ads import (
    with_time, user_day_ad_counts, blacklist_users, blacklist_crossings, blacklist_filtered_clicks,
    day_area_city_ad_counts, day_area_ad_counts, day_area_ad_top3, day_area_ad_top3_json,
    day_top3_document, ad_minute_trend, ad_recent_trend, last_surviving_minute, ad_minute_trend_json, ad_last_hour_sliding,
)
from clickpulse.operators.merge import merge_counts
from clickpulse.operators.topk import top_k_per_group, kth_per_group
