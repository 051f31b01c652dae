"""Session settings, table loading and the shared folder for written stages."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Everything the engine wants of a session; a cluster's own settings win where they are set.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


@lru_cache(maxsize=16)
def _package_zip() -> str:
    """This package as a file on the driver, from where Spark hands it to the executors."""
    root = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="tessera-package-")) / "tessera.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    return str(path)


@lru_cache(maxsize=16)
def _ship(application: str) -> None:
    SparkSession.active().sparkContext.addPyFile(_package_zip())


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable on all executors, once per application, wherever they run and however it was started."""
    _ship(spark.sparkContext.applicationId)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tessera")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return ship(
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return ship(spark).read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan for work that is heavy per row, dealt out to at least ``spark.tessera.minSplits`` tasks where the session sets that.

    Unset (the default), rows stay where they are read, without a shuffle, at every size. A machine whose tables are single small files
    sets it to its cores. Give it the needed columns only.
    """
    least = int(df.sparkSession.conf.get("spark.tessera.minSplits", "0"))
    return df.repartition(least) if least else df


_written: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one that all executors share.

    The cluster names it in ``spark.checkpoint.dir``; on a cluster it is an error to leave that unset. Only a local
    master (tests, one machine) falls back to a temporary folder. All folders of an application lie in one, which :func:`drop_stored` deletes.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(base)
    own = f"{base.rstrip('/')}/tessera-{spark.sparkContext.applicationId}"
    if own not in _written:
        _written[own] = spark.sparkContext.applicationId
        atexit.register(_drop_quietly, spark)
    return f"{own}/{uuid.uuid4().hex}"


def drop_stored(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; also done when the driver ends in the ordinary way.

    DataFrames that read it are of no use afterwards.
    """
    if spark.sparkContext._jsc is None:  # stopped before
        return
    for own in [k for k, a in _written.items() if a == spark.sparkContext.applicationId]:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        del _written[own]


def _drop_quietly(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the JVM may have gone first
        drop_stored(spark)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, and a lost executor loses nothing."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
