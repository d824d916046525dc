"""Run one registered query (or the build) and print per-stage task counts
and durations from the status tracker (no UI needed)."""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hiresight.plans import pipeline  # noqa: E402
from hiresight.plans.queries import QUERIES  # noqa: E402
from hiresight.session import local_session  # noqa: E402
from hiresight.sources import testdata  # noqa: E402

sf, name = sys.argv[1], sys.argv[2]
import glob
import json
import tempfile

logdir = tempfile.mkdtemp(prefix="evlog-")
spark = local_session(8, int(os.environ.get("SP", "16")), extra={"spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
                                    "spark.sql.adaptive.advisoryPartitionSizeInBytes": os.environ.get("MINP", "64m"), "spark.sql.adaptive.coalescePartitions.parallelismFirst": os.environ.get("PF", "true"),
                                    "spark.eventLog.dir": logdir, "spark.eventLog.rolling.enabled": "false",
                                    "spark.eventLog.compress": "false"})
sc = spark.sparkContext
make = (lambda: pipeline.build_jobs(testdata.raw_postings(spark, sf))) if name == "build" else (lambda: QUERIES[name](spark, sf))
for rep in range(2):
    t = time.time()
    make().write.format("noop").mode("overwrite").save()
    print(f"run {rep}: {time.time() - t:.2f}s")
spark.stop()
for f in glob.glob(f"{logdir}/**", recursive=True):
    if os.path.isdir(f):
        continue
    for line in open(f):
        ev = json.loads(line)
        if ev.get("Event") == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            dur = (si["Completion Time"] - si["Submission Time"]) / 1000
            if dur > 0.2:
                print(f"  stage {si['Stage ID']:4d} tasks={si['Number of Tasks']:3d} {dur:6.2f}s {si['Stage Name'][:50]}")
