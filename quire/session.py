"""Session helpers."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the session comes from outside."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("quire")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true").config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python workers can import it."""
    root, digest = Path(__file__).resolve().parent, hashlib.sha256()
    files = sorted(root.rglob("*.py"))
    for path in files:
        digest.update(path.read_bytes())
    name = f"quire-{digest.hexdigest()[:16]}.zip"
    if any(sent.endswith(name) for sent in spark.sparkContext.listFiles):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="quire-ship-"), name)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for path in files:
            z.write(path, str(Path("quire") / path.relative_to(root)))
    spark.sparkContext.addPyFile(target)
