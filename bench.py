"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("OMP_NUM_THREADS", "1")

NAMES = ["extract_filters", "domain_stats", "refine_documents", "para_dedup", "simhash", "neardup_keep", "badword_screen", "segment_scores_select", "domain_bucket_salt", "clean_regex"]


def main() -> None:
    from pyspark.sql import SparkSession

    from winnowry.plans.queries import QUERIES

    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="winnowry-bench-")).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in ["extract_filters", *NAMES]:  # the first run warms up
        began = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
