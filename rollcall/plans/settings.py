"""Settings of a session that the plans of this library profit from on large tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

_FILTER = "spark.sql.optimizer.runtime.bloomFilter"

#: Where orders are filtered (by period) and lines are of 10 GB or more, Spark builds a Bloom
#: filter of the order keys that are left and tests it in the scan of the lines, before they are
#: summed and shuffled per order. By default it does so only for orders of up to 10 MB. Orders of
#: 1 GB have some 40 million rows; a filter of 16 MB holds 10 million keys at 13 bits each. Larger
#: ones would pass nearly every line: Spark then leaves the filter out, and tables saved in
#: buckets (``save_mart_inputs``) need no shuffle at all.
RECOMMENDED = {
    f"{_FILTER}.enabled": "true",
    f"{_FILTER}.creationSideThreshold": "1g",
    f"{_FILTER}.expectedNumItems": "10000000",
    f"{_FILTER}.maxNumItems": "10000000",
    f"{_FILTER}.maxNumBits": str(1 << 27),
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what is recommended in the session of the caller, who alone decides about it."""
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark
