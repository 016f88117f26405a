"""SparkSession construction and session-level policies.

Library code never builds its own session: every pipeline takes the caller's
``SparkSession``. This module is for entry points (bench, tests, seed jobs)
that need one, and for the checkpoint-directory policy shared by all jobs.
"""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale, whatever the master:
#  * AQE re-plans from real shuffle sizes: coalesces small partitions,
#    converts a sort-merge join to broadcast once a side is measured small,
#    and splits skewed join partitions (a hot key may hold a third of rows).
#  * autoBroadcastJoinThreshold is Spark's own size check on plan statistics;
#    sides above it are never broadcast by the planner.
SCALE_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # coalesce to the advisory size, not to the default parallelism: on a
    # large cluster the latter leaves thousands of tiny post-shuffle tasks
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # runtime size check: a sort-merge join whose build side measures at
    # most this per post-shuffle partition (every partition) becomes a
    # shuffled hash join, so the big side is not sorted; a skewed partition
    # above it keeps the sort-merge join and AQE's skew split
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "256m",
    # a whole-stage method over HotSpot's 8000-byte JIT limit runs
    # interpreted (a 50-column generated table: 5x slower); above this
    # size Spark compiles that stage per expression instead (split methods)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # before a query runs, sizes are estimates that grow with the scan: the
    # planner broadcasts only what it estimates under Spark's own default.
    # AQE may go further, as it has measured the side it broadcasts
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the scale settings above.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (or ``local[*]``) only
    when no master is configured by spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        cpus = os.environ.get("BENCH_CPUS", "*")
        master = f"local[{cpus}]"
    if master:
        builder = builder.master(master)
    confs = dict(SCALE_CONFS)
    confs["spark.ui.enabled"] = "false"
    if master and master.startswith("local"):
        # local mode: the driver is the only JVM, so its heap is the memory
        # knob; half of the machine leaves room for the Python workers
        memory = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        confs.setdefault("spark.driver.memory", f"{max(1, memory // 2 >> 30)}g")
    if shuffle_partitions is not None:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.update(extra or {})
    for k, v in confs.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()

# Bytes of a batch that a Python worker is sent; Spark's own bound is 64 MB, held
# several times at once by a task's JVM and worker.
ARROW_BATCH_BYTES = 4 << 20


def bound_arrow_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session has a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(ARROW_BATCH_BYTES))


def package_zip() -> bytes:
    """The package's Python files as a zip that ``sys.path`` can hold."""
    root = os.path.dirname(os.path.abspath(__file__))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    return out.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerline`` importable in executor Python workers.

    Only Python-side operators (``mapInPandas``, pandas UDFs) need it. The
    package is zipped and given to ``SparkContext.addPyFile``, which sends it to
    every executor under any master and puts it on the workers' ``sys.path``.
    An error is raised, not swallowed, and the next call tries again.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: ship with spark.addArtifacts instead
        return
    if sc.applicationId in _SHIPPED:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-ship-"), "ledgerline.zip")
    with open(path, "wb") as f:
        f.write(package_zip())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def runs_in_one_process(master: str) -> bool:
    """True for ``local`` and ``local[...]``: one machine, one JVM. A
    ``local-cluster[...]`` has executors with folders of their own."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as-is. Only a local-mode session with no setting (local runs,
    tests) gets a fresh scratch folder; a cluster session without one is an
    error, so lineage cuts never land on a machine-local path. Under Spark
    Connect the server's own setting applies and is returned as configured.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no client-side context
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not runs_in_one_process(sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder for lineage cuts on this cluster")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
