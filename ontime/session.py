"""Session reuse and shared storage locations.

A library never owns the session: it reuses the active one (a notebook, a
job submitted to a cluster) and only builds one when none exists, as in tests
and local runs.  Anything the library writes (layers, models, CSV extracts,
lineage cuts) goes under the cluster's shared checkpoint folder, read from
``spark.checkpoint.dir``; a local folder is picked only when that setting is
absent, which only happens outside a cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a local session gets; a cluster job brings its own.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
    # whole-stage method above that runs interpreted (7x slower on the wide
    # cleaning projections), so fall back to per-operator codegen instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Only for a local master: a cluster sizes its shuffles itself.
LOCAL_CONF = {**SESSION_CONF, "spark.sql.shuffle.partitions": "8"}


def is_local(master: str) -> bool:
    """One JVM on one machine (``local``, ``local[8]``), whose disk all tasks share."""
    return master == "local" or master.startswith("local[")


def get_spark(master: str | None = None, app_name: str = "ontime",
              warehouse_dir: str | None = None, conf: dict | None = None, hive: bool = False) -> SparkSession:
    """Return the active session, else build one.

    ``master``, ``warehouse_dir`` and ``hive`` only apply when a new session is
    built.  ``hive`` adds Hive support, so registered tables outlive the
    session; it needs a metastore service, whose address belongs in the
    deployment's ``spark-defaults``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    base = LOCAL_CONF if is_local(master or "local") else SESSION_CONF
    for k, v in {**base, **(conf or {})}.items():
        builder = builder.config(k, v)
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def keep_compiled(spark: SparkSession) -> SparkSession:
    """Lower the size above which a generated method is given up to what HotSpot compiles (``SESSION_CONF``).

    A session built elsewhere has Spark's own 65,535: the stages that type, filter and hash the flight view then run
    interpreted in every pass.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(SESSION_CONF[name]):
        spark.conf.set(name, SESSION_CONF[name])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder (``spark.checkpoint.dir``).

    Set only when unset and the master is local (tests), never overridden; on
    a cluster an unset folder is an error, as executors can't see each other's
    disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ontime-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one output."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
