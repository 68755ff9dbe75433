"""Sessions, and the library's code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on one machine, for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lumenmap").config("spark.driver.memory", memory).config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context, so that their Python workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_lumenmap_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.parent.suffix != ".zip":
        fd, name = tempfile.mkstemp(prefix="lumenmap-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(name, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        context.addPyFile(name)
    context._lumenmap_shipped = True
