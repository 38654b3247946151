"""Queries on workers that cannot import the package: kernels travel with the job."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from sieveline.session import session

spark = session("elsewhere", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": {shared!r}}})
spark.sparkContext.setLogLevel("ERROR")

def missing(_):
    try:
        import sieveline
    except ImportError:
        yield True
    else:
        yield False

# The test says nothing if the package is there.
assert all(spark.sparkContext.parallelize(range(4), 4).mapPartitions(missing).collect())
queries = entry.queries()
for name in sorted(queries):
    if name.startswith("op") and name[2].isdigit() or name in {others!r}:
        queries[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        print("ran", name)
"""

OTHERS = ("knn_exact", "knn_pruned", "knn_in_clusters", "knn_living_index", "recall_similarity")


def test_queries_run_on_workers_without_the_package(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(repo=str(REPO), shared=str(tmp_path / "shared"), others=OTHERS))
    paths = [part for part in os.environ.get("PYTHONPATH", "").split(os.pathsep) if part and Path(part).resolve() != REPO]
    environment = os.environ | {"PYTHONPATH": os.pathsep.join(paths)}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=1200)
    ran = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert done.returncode == 0, done.stderr[-3000:]
    assert set(OTHERS) < set(ran) and sum(name.startswith("op") for name in ran) == 13
