"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.abspath(__file__)))

from tablewright.catalog import QUERIES  # noqa: E402
from tablewright.session import local_session  # noqa: E402

HEADLINES = [
    "a1_parquet_scan", "a10_json_payloads", "b7_exact_sample", "c1_impute_mean", "c2_cast_numbers",
    "c7_replace_words", "d1_many_levels", "d2_value_index", "d6_class_weights",
    "e1_ensemble_scalar", "e2_ensemble_vector", "e3_ensemble_back", "e5_summary_counts",
    "e7_summary_sample", "e9_summary_all", "e9_summary_approximate", "f2_assemble_numbers",
    "f4_word_counts", "f9_tokenize", "f13_tf_idf", "g2_resize_down", "g10_batch_score",
    "h6_regression_metrics", "h7_binary_metrics", "h9_area_under_roc", "h11_instance_regression_loss",
    "h3_train_regressor", "i1_stream_imputed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cores, memory=os.environ.get("BENCH_MEMORY", "12g"), app="bench")
    # one small job, so that the first query does not pay for starting up
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        start = time.monotonic()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
    spark.stop()
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": float(found.group(1)) if found else sf_dir}))


if __name__ == "__main__":
    main()
