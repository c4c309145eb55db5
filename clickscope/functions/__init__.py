from clickscope.functions.text import json_pairs, percent_sql, split_id_list_sql
from clickscope.functions.city_remark import register_city_remark

__all__ = ["json_pairs", "percent_sql", "split_id_list_sql", "register_city_remark"]
