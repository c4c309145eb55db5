from clickscope.operators.actions import filter_actions
from clickscope.operators.category import (category_action_counts, category_top10,
                                           category_session_top10, category_session_counts)
from clickscope.operators.pageflow import page_visit_counts, page_jump_counts, page_conversion
from clickscope.operators.area import (enrich_clicks, area_city_product_counts, city_remark,
                                       area_product_counts, area_product_top3, area_top_products)
from clickscope.operators.ads import (day_area_city_ads, area_ads_top3, area_ads_top3_json,
                                      blacklist_hits, blacklist_users, blacklist_since,
                                      ads_not_blacklisted, drop_blacklisted, last_hour_ads,
                                      last_hour_json)
from clickscope.operators.adjacency import adjacent_pairs

__all__ = [n for n in dir() if not n.startswith("_")]
