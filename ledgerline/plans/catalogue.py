"""The driver tables seen as the catalogue.

``lineitem`` plays the raw ``media`` table (many rows per title, keyed by
``l_orderkey``) and ``orders`` plays ``training``. The derived columns are
plain projections, so Catalyst prunes and pushes filters through them into
the Parquet scan. Each definition here has a twin in the oracle SQL
(:mod:`ledgerline.plans.oracle`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.enums import EnumType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# fixed values of the adaptation: the return flag treated as an enumerated
# column whose declaration order differs from its text order, and the order
# priorities declared from lowest to most urgent.
RETURN_FLAG = EnumType("return_flag", ("R", "A", "N"))
ORDER_PRIORITY = EnumType("order_priority", ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"))
ORDER_STATUS = EnumType("order_status", ("O", "P", "F"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def media_rows(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as raw media rows.

    * ``title_key``: the order key, missing (NULL) on the first line of
      returned-``N``/open orders -- untitled rows, and some titles appear only
      in such rows;
    * ``status``: a rejection status derived from flag, line status and
      quantity, unknown (NULL) on small ``N``/``F`` lines;
    * ``title``: missing on open lines;
    * ``tags``: a two-element array whose second element is NULL when the
      status is unknown.
    """
    rf, ls, q = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    status = (F.when((rf == "A") & (ls == "F"), F.lit("accepted"))
              .when((rf == "R") & (ls == "F"), F.lit("rejected"))
              .when((rf == "A") & (ls == "O") & (q > 45), F.lit("override"))
              .when((rf == "N") & (ls == "F") & (q <= 5), F.lit(None).cast("string"))
              .otherwise(F.lit("unfiltered")))
    key = F.when((F.col("l_linenumber") == 1) & (rf == "N") & (ls == "O"),
                 F.lit(None).cast("long")).otherwise(F.col("l_orderkey"))
    title = F.when(ls == "O", F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")))
    tags = F.array(rf, F.when(status.isNull(), F.lit(None).cast("string")).otherwise(ls))
    return lineitem.select(
        key.alias("title_key"), status.alias("status"), title.alias("title"),
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", F.col("l_returnflag").alias("l_returnflag", metadata=RETURN_FLAG.metadata),
        "l_linestatus", "l_shipdate", tags.alias("tags"),
    )


MEDIA_MAX_COLUMNS = ("title", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                     "l_shipdate", "tags")


def training_keys(orders: DataFrame) -> DataFrame:
    """Titles already in training: finished orders."""
    return orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("title_key"))


def tags_text(c: str = "tags") -> F.Column:
    """Array as comparable text; NULL elements shown as ``~``."""
    return F.array_join(F.col(c), "|", "~")
