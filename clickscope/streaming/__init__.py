from clickscope.streaming.keyed import KeyedTable, TableClaimed
from clickscope.streaming.blacklist import blacklist_stream
from clickscope.streaming.ads_jobs import (Trigger, AVAILABLE_NOW, start_running_counts, start_last_hour,
                                           start_blacklist, start_blacklist_tables, start_rejects,
                                           apply_blacklist_batch, count_batch, compact_tables,
                                           read_blacklist_tables, start_ads_jobs, read_blacklist,
                                           read_passed_clicks, read_last_hour, read_last_hour_json, read_table)

__all__ = [n for n in dir() if not n.startswith("_")]
