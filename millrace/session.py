"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "millrace", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once for an application, so that functions on rows find their
    module also where it is not installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        if root.is_dir():  # not where the package itself came in an archive
            base = f"{tempfile.mkdtemp(prefix='millrace-')}/millrace"
            context.addPyFile(shutil.make_archive(base, "zip", root.parent, root.name))
        _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Where none is named, one process gets a temporary folder;
    on a cluster other machines could not read that, so it is an error there."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_roots: dict[str, str] = {}


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; also done when Python ends with the
    session still open."""
    path = _roots.pop(spark.sparkContext.applicationId, None)
    if path:
        _remove(spark, path)


def _root(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    ident = spark.sparkContext.applicationId
    if ident not in _roots:
        _roots[ident] = f"{shared_dir(spark)}/millrace/{ident}"
        atexit.register(lambda: spark.sparkContext._jsc and release(spark))
    return _roots[ident]


_scope: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    folder = _scope.get() or _root(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables written inside are removed at the end; what is read from them
    has to be used up before."""
    folder = scratch_path(spark, "scope")
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        _remove(spark, folder)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: the lineage is cut and the
    rows stay as they are, also when executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
