"""Order lines with gaps and marker texts, as published statistics have them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build_unclean_lines(lineitem: DataFrame) -> DataFrame:
    """One row per line, with NULLs, the text ``null`` and ``:`` where the order key says so: one
    projection, so the rows grow with the table and stay where they are read.
    """

    def every(step: int) -> Column:
        return F.col("l_orderkey") % step == 0

    supplier = F.when(every(6), ":").otherwise(F.col("l_suppkey").cast("string"))
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(every(11), "null").when(every(17), F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag_s"),
        F.when(~every(7), F.col("l_quantity").cast("int")).alias("quantity_i"),
        F.when(~every(5), F.col("l_partkey")).alias("part_l"),
        F.when(~every(13), F.col("l_extendedprice")).alias("price_d"),
        F.when(~every(9), supplier).alias("supplier_s"),
    )
