from clickscope.sources.tables import ActionModel, load_tables, read_table
from clickscope.sources.ads_log import parse_ads_log, kafka_ads_stream, text_ads_stream

__all__ = ["ActionModel", "load_tables", "read_table", "parse_ads_log",
           "kafka_ads_stream", "text_ads_stream"]
