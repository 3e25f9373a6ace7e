"""Session set-up and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: The folder of a local session without the setting, which Spark doesn't let a running session change.
_LOCAL_ROOTS: dict[str, str] = {}
#: Applications whose workers have this package.
_SHIPPED: set[str] = set()


def build_session(app: str = "rostrum", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for.

    No operator depends on a setting made here: timestamps are zone-free
    (`timestamp_ntz`), parsing uses `try_*`, and duplicate map keys are resolved in
    the expression, so the same results come out of any caller's session.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder named by `spark.checkpoint.dir`.

    The setting is read from the session. Only a local session that has none gets a
    folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder does not survive the loss of that machine.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS[app] = _LOCAL_ROOTS.get(app) or tempfile.mkdtemp(prefix="rostrum-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage of a long job, and keeps results that must not be computed twice
    (calls to a scorer) across the loss of executors.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application.

    Functions that run in workers are found by their module; a session that was not started from the
    folder of the package has workers that can't import it.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="rostrum-code-")) / "rostrum.zip"
    with zipfile.ZipFile(path, "w") as pack:
        for file in sorted(here.rglob("*.py")):
            pack.write(file, str(Path("rostrum") / file.relative_to(here)))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)


def with_package[**P, R](job: Callable[P, R]) -> Callable[P, R]:
    """`job` (spark, ...) with the package shipped before it runs."""
    @wraps(job)
    def run(spark, *args, **more):
        ship_package(spark)
        return job(spark, *args, **more)

    return run
