"""Spark sessions with the settings that the sources and operators rely on."""

from __future__ import annotations

import atexit
import logging
import shutil
import tempfile
import zipfile
from logging.handlers import RotatingFileHandler
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that change results, not speed.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # windows-1252 is refused otherwise.
    "spark.sql.legacy.javaCharsets": "true",
    # Short rows are dropped only where all columns are parsed.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "tessera", **conf: str) -> SparkSession:
    """A session; `conf` wins over the defaults, dots written as double underscores."""
    given = {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    for k, v in (ADAPTIVE | REQUIRED | given).items():
        builder = builder.config(k, v)
    spark = prepared(builder.getOrCreate())
    ship(spark)
    return spark


def prepared(spark: SparkSession) -> SparkSession:
    """A session that exists already, with the settings that change results."""
    for k, v in REQUIRED.items():
        spark.conf.set(k, v)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, wherever they run; once for each."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root, folder = Path(__file__).resolve().parent, Path(tempfile.mkdtemp(prefix="tessera-package-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "tessera.zip", "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(folder / "tessera.zip"))
    _shipped.add(spark.sparkContext.applicationId)


def log_to(folder: str, level: int = logging.INFO) -> logging.Logger:
    """The package's log, on the console and in a file that starts anew at 10 MB; set up once."""
    log = logging.getLogger("tessera")
    if not log.handlers:
        Path(folder).mkdir(parents=True, exist_ok=True)
        form = logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s")
        for handler in (logging.StreamHandler(), RotatingFileHandler(Path(folder) / "tessera.log", maxBytes=10_000_000, backupCount=5, encoding="utf-8")):
            handler.setFormatter(form)
            log.addHandler(handler)
    log.setLevel(level)
    return log
