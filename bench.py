"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores. A query's time is
that of building it (with the writes of sinks and jobs) and of computing all its rows.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneflow.operators.quality import classify, good_rows
from paneflow.operators.windows import batch_summary, count_batches, with_window
from paneflow.plans.messages import messages
from paneflow.plans.queries import QUERIES, events
from paneflow.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: A window that holds all rows, the case that puts them all in one task when done plainly.
SKEWED, BATCH_ROWS = "365 days", 1000


def compute(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    began = time.perf_counter()
    run()
    return round(time.perf_counter() - began, 3)


def plain_batches(rows: DataFrame) -> DataFrame:
    """What the numbering is compared with: one window function over whole windows."""
    whole = Window.partitionBy("window_start").orderBy("ts", "event_id")
    numbered = with_window(rows, SKEWED).withColumn("rn", F.row_number().over(whole))
    return batch_summary(numbered.withColumn("batch_no", F.expr(f"(rn - 1) div {BATCH_ROWS}")))


def main() -> None:
    spark = local_session(CPUS, **{"spark.sql.shuffle.partitions": CPUS})
    compute(QUERIES["job_keyed"](spark, SF_DIR))

    times = {name: timed(lambda: compute(query(spark, SF_DIR))) for name, query in QUERIES.items()}

    rows = events(spark, SF_DIR).select("ts", "event_id")
    n = rows.count()
    skewed = {"skewed_window_plain": timed(lambda: compute(plain_batches(rows)))}
    for method in ("slices", "range"):
        skewed[f"skewed_window_{method}"] = timed(
            lambda: compute(batch_summary(count_batches(rows, SKEWED, BATCH_ROWS, method=method)))
        )
    gate = timed(lambda: compute(good_rows(classify(messages(events(spark, SF_DIR))))))

    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {**times, **skewed},
                "gate_and_bind_rows_per_sec": round(n / gate),
                "rows": n,
                "cpus": CPUS,
                "sf": SF_DIR,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
