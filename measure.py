"""Time the daily build, the factors and the adjusted prices on a large derived table.

The rows of the driver's ``events`` are multiplied by a date and code offset until there
are about 16 million daily bars; one code can be given a large share of the landed rows
(as repeated copies of its bars) to see that it does not slow the build down.

    python measure.py [rows in millions] [share of the hot code]
"""

from __future__ import annotations

import json
import sys
import tempfile
import time

from pyspark.sql import functions as F

from barlake.operators.windows import adjust_forward
from barlake.plans import silver
from barlake.session import local_session

CODES = 5210


def main() -> None:
    millions = float(sys.argv[1]) if len(sys.argv) > 1 else 16
    hot = float(sys.argv[2]) if len(sys.argv) > 2 else 0.0
    spark = local_session("8", "32", "4g")
    root = tempfile.mkdtemp(prefix="barlake-measure-")
    rows = int(millions * 1e6)
    n = F.col("id")
    base = spark.range(rows).select(
        F.lpad((n % CODES).cast("string"), 6, "0").alias("stock_code"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.floor(n / CODES).cast("int")).cast("string").alias("datetime"),
        (10 + n * 7919 % 997 / 100).alias("close"), (n * 31 % 100000).cast("double").alias("volume"),
    ).withColumns({
        "open": F.col("close") - 0.1, "high": F.col("close") + 0.5, "low": F.col("close") - 0.5,
        "amount": F.col("close") * F.col("volume"),
    })
    if hot:
        copies = int(hot / (1 - hot) * CODES)
        again = base.filter(F.col("stock_code") == "000000").withColumn(
            "copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))
        ).drop("copy")
        base = base.unionByName(again)
    base.write.parquet(f"{root}/primary")
    events = spark.range(CODES * 20).select(
        F.lpad((n % CODES).cast("string"), 6, "0").alias("code"), F.lit(2000).alias("year"),
        (n % 12 + 1).alias("month"), (n % 27 + 1).alias("day"), F.lit(1).alias("category"),
        F.lit(1.0).alias("fenhong"), F.lit(0.0).alias("peigujia"), F.lit(1.0).alias("songzhuangu"), F.lit(0.0).alias("peigu"),
    )
    timings = {}

    def timed(name, df):
        started = time.perf_counter()
        df.write.parquet(f"{root}/{name}")
        timings[name] = round(time.perf_counter() - started, 2)
        return spark.read.parquet(f"{root}/{name}")

    landed = spark.read.parquet(f"{root}/primary")
    timings["landed_rows"] = landed.count()
    daily = timed("daily", silver.daily_bars(landed)[0])
    factors = timed("factors", silver.adj_factors(events, daily))
    timed("adjusted", adjust_forward(daily, factors))
    timings["daily_rows"] = daily.count()
    print(json.dumps(timings))
    spark.stop()


if __name__ == "__main__":
    main()
