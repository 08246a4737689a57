"""Stage timings of registered queries, from Spark's event log.

usage: python tools/stages.py KEY [KEY ...]

Runs each key once (warm-up) and once measured at $BENCH_SF_DIR (default
sf0.1) on local[8] with the event log written to a fresh folder under
/tmp (no UI), then prints, per SQL execution of the measured run, its
duration and job count, and per stage its task count, duration and
shuffle bytes written.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tarmac.catalog import queries as Q  # noqa: E402
from tarmac.session import configure  # noqa: E402


def run(keys: list[str], sf_dir: str, log_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(log_dir, "ckpt"))
    configure(spark)
    for key in keys:
        for label in (f"{key}:warm-up", key):
            spark.sparkContext.setJobDescription(label)
            Q.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()


def report(log_dir: str, keys: list[str]) -> None:
    executions, jobs, stages = {}, {}, {}
    shuffle = defaultdict(int)
    for path in glob.glob(os.path.join(log_dir, "*", "events*")) + glob.glob(os.path.join(log_dir, "local-*")):
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                kind = e["Event"]
                if kind.endswith("SQLExecutionStart"):
                    executions[e["executionId"]] = [e["time"], None]
                elif kind.endswith("SQLExecutionEnd"):
                    executions[e["executionId"]][1] = e["time"]
                elif kind == "SparkListenerJobStart":
                    props = e.get("Properties", {})
                    jobs[e["Job ID"]] = (props.get("spark.job.description"), props.get("spark.sql.execution.id"),
                                         e["Stage IDs"])
                elif kind == "SparkListenerStageCompleted":
                    s = e["Stage Info"]
                    stages[s["Stage ID"]] = (s["Number of Tasks"], s.get("Submission Time"), s.get("Completion Time"))
                elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    shuffle[e["Stage ID"]] += e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    for key in keys:
        print(f"== {key}")
        by_exec = defaultdict(list)
        for job_id, (desc, exec_id, stage_ids) in sorted(jobs.items()):
            if desc == key and exec_id is not None:
                by_exec[int(exec_id)].append((job_id, stage_ids))
        for exec_id, exec_jobs in sorted(by_exec.items()):
            start, end = executions.get(exec_id, (None, None))
            took = end - start if start and end else None
            print(f"  execution {exec_id}: {took} ms, {len(exec_jobs)} job(s)")
            for _, stage_ids in exec_jobs:
                for sid in stage_ids:
                    if sid in stages:
                        tasks, a, b = stages[sid]
                        print(f"    stage {sid}: {tasks} task(s), {b - a} ms, shuffle write {shuffle[sid]} B")


def main() -> None:
    keys = sys.argv[1:]
    if not keys:
        raise SystemExit(__doc__)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    run(keys, sf_dir, log_dir)
    report(log_dir, keys)


if __name__ == "__main__":
    main()
