"""The listings view over the order tables, and its noisy raw form."""

import os
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.columns import (AVAILABLE, DATE, ENTITY, FUEL, FUELS, ID, PRICE, RESERVED, SOLD,
                           STATUS, UNKNOWN_ENTITY, YEAR)

ORDER_STATUS = {"F": SOLD, "O": AVAILABLE, "P": RESERVED}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


# Known schemas of the source tables: reading with them starts no schema inference job.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey long, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey long, n_name string, n_regionkey long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _lookup(column: str, pairs: dict[str, str]):
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(pairs.items())])[F.col(column)]


def listings(spark: SparkSession, sf_dir: str, entity: bool = True) -> DataFrame:
    """One listing per order. The customer join only supplies the entity name: an order without a
    customer keeps its place under a default name, so ``entity=False`` leaves the join out without
    changing the rows."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(ID),
        F.col("o_custkey"),
        (F.year("o_orderdate") - F.col("o_custkey") % 15).cast("int").alias(YEAR),
        F.col("o_totalprice").alias(PRICE),
        F.col("o_orderdate").cast("date").alias(DATE),
        _lookup("o_orderpriority", dict(zip(PRIORITIES, FUELS))).alias(FUEL),
        _lookup("o_orderstatus", ORDER_STATUS).alias(STATUS),
    )
    if not entity:
        return orders
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    names = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.concat_ws(
            " ", F.initcap("c_mktsegment"), F.replace("n_name", F.lit("NATION_"), F.lit("N"))
        ).alias(ENTITY))
    )
    return orders.join(names, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        ID, F.coalesce(ENTITY, F.lit(UNKNOWN_ENTITY)).alias(ENTITY), YEAR, PRICE, DATE, FUEL, STATUS, "o_custkey")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
