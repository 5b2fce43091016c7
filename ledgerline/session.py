"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster, ``master`` stays None and the submit command decides;
    tests pass ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we read it from the session.
    Only when it is unset (local tests) do we make a scratch folder of our own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
