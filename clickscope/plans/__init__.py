from clickscope.plans.checks import QUERIES, HEADLINE
from clickscope.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "HEADLINE", "ORACLE_SQL"]
