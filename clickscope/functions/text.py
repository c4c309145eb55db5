"""Column helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_id_list_sql(expr: str) -> str:
    """SQL text that splits the comma list ``expr`` with java.lang.String.split semantics.

    Java drops trailing empty pieces ("3,5," -> [3, 5]) and returns no piece
    at all for a list made only of commas, but one empty piece for "".
    Spark's ``split`` keeps trailing empties, so they are stripped first.
    NULL stays NULL.
    """
    return (f"CASE WHEN ({expr}) IS NULL THEN NULL WHEN ({expr}) RLIKE '^,+$' THEN CAST(array() AS ARRAY<STRING>) "
            f"ELSE split(regexp_replace({expr}, ',+$', ''), ',') END")


def percent_sql(expr: str, pattern: str) -> str:
    """SQL text of a ratio as percent text, with a java.text.DecimalFormat pattern.

    Rounding is HALF_EVEN like the reference's DecimalFormat (".00%" renders
    0.005 as ".50%", "0.00%" as "0.50%").
    """
    return f"format_number({expr}, '{pattern}')"


def json_pairs(items: Column, key_field: str, value_field: str) -> Column:
    """array<struct> -> JSON array of one-field objects: [{"k1":v1},{"k2":v2}].

    This is the rendering of a Scala list of pairs by json4s in the
    reference; order is the array order.
    """
    return F.to_json(F.transform(items, lambda e: F.create_map(e[key_field], e[value_field])))
