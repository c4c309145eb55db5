"""Scan the action log and its three dimensions.

The reference reads four Hive tables of one database.  Here they come either
from the catalog (``database=``) or from a folder of Parquet datasets
(``path=``), always with an explicit schema so nothing is inferred.  Store the
action log partitioned by ``date``: the date predicates of the filter then
prune whole partitions at the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickscope import schemas

TABLES = {
    "user_visit_action": schemas.USER_VISIT_ACTION,
    "user_info": schemas.USER_INFO,
    "city_info": schemas.CITY_INFO,
    "product_info": schemas.PRODUCT_INFO,
}


@dataclass(frozen=True)
class ActionModel:
    """The batch data model: fact plus dimensions, all lazy DataFrames."""

    actions: DataFrame
    users: DataFrame
    cities: DataFrame
    products: DataFrame


def read_table(spark: SparkSession, name: str, *, database: str | None = None,
               path: str | None = None) -> DataFrame:
    schema = TABLES[name]
    if database is not None:
        df = spark.table(f"{database}.{name}")
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields],
                         *[c for c in df.columns if c not in schema.fieldNames()])
    if path is None:
        raise ValueError("give database= or path=")
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{name}")


def load_tables(spark: SparkSession, *, database: str | None = None,
                path: str | None = None) -> ActionModel:
    return ActionModel(
        actions=read_table(spark, "user_visit_action", database=database, path=path),
        users=read_table(spark, "user_info", database=database, path=path),
        cities=read_table(spark, "city_info", database=database, path=path),
        products=read_table(spark, "product_info", database=database, path=path),
    )
