"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings any session must have, also one made elsewhere.
RUNTIME_CONF = {
    # Every day boundary and epoch conversion in the library is UTC.
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles a method above 8000 bytes of bytecode. Wide flattening projections can exceed that; they
    # run several times faster as separate, compiled expressions than as one interpreted whole-stage method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
SESSION_CONF = {
    **RUNTIME_CONF,
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "engage", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword arguments (dots written as ``__``) override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session that names no such folder (a test) gets a temporary one, the same for the whole session; any
    other session without a shared folder is refused before anything is made.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="engage-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
