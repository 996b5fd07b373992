"""Times the registered queries and prints one JSON line.

``batch_job`` is the whole job from the raw feeds to the six stored tables. Reports and checks
then read those tables; rules, operators and storage queries start from the raw feeds. Every
result is consumed in full by Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import time

from reviewmill.plans import registry
from reviewmill.sources.session import create_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = create_session(
        "bench",
        {
            "spark.master": f"local[{CPUS}]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": CPUS,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    seconds = {}
    start = time.perf_counter()
    registry.lake(spark, SF_DIR).build()
    seconds["batch_job"] = round(time.perf_counter() - start, 3)
    for name, query in registry.QUERIES.items():
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total time of the batch job and all registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
