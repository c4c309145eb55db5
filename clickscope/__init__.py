"""Shop behaviour analytics as PySpark DataFrame operators.

Batch reports over a user-action log (category funnel, sessions per category,
page-to-page conversion, top products per area with city shares) and
Structured Streaming jobs over an ad-click log (blacklist, running counts,
top ads per area, last-hour clicks).  Every operator is a function from
DataFrame(s) to DataFrame; nothing is collected to the driver.
"""

from clickscope.config import Condition, DEFAULT_CONDITION

__all__ = ["Condition", "DEFAULT_CONDITION"]
