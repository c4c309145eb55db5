from clickscope.sinks.tables import (JdbcTarget, overwrite_table, append_table, jdbc_overwrite,
                                     save_table)

__all__ = ["JdbcTarget", "overwrite_table", "append_table", "jdbc_overwrite", "save_table"]
