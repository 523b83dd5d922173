"""Session, shared scratch folder and lineage cuts."""

from __future__ import annotations

import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and single-machine work; clusters bring their own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("granary")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the session names none, a local one (tests) makes one and sets it;
    on a cluster that is an error, as executors share no local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='granary-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root


#: Applications whose scratch folder is marked to go.
_MARKED: set[str] = set()
#: Scratch tables of the innermost scratch() block.
_OWN: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in this application's scratch folder, which goes when the driver ends in order."""
    app = spark.sparkContext.applicationId
    home = f"{scratch_root(spark)}/granary-{app}"
    if app not in _MARKED:
        fs, at = _folder(spark, home)
        fs.mkdirs(at)  # only what exists can be marked
        fs.deleteOnExit(at)
        _MARKED.add(app)
    return f"{home}/{tag}-{uuid.uuid4().hex}"


def stage(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there.

    Unlike a local checkpoint the files outlive any executor, and the reread
    frame has true sizes for the planner.
    """
    path = scratch_path(df.sparkSession, tag)
    if (own := _OWN.get()) is not None:
        own.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Deletes the tables staged in the block at its end, but for those of the
    frames put on the list: for functions whose result is staged itself."""
    outer, own, keep = _OWN.get(), [], []
    token = _OWN.set(own)
    try:
        yield keep
    finally:
        _OWN.reset(token)
        read = " ".join(f for df in keep for f in df.inputFiles())
        for path in own:
            if path.rsplit("/", 1)[1] in read:
                if outer is not None:
                    outer.append(path)
            else:
                fs, at = _folder(spark, path)
                fs.delete(at, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once, wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).parent
        if package.suffix != ".zip" and package.is_dir():
            made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='granary-')}/granary-package", "zip", package.parent, package.name)
            sc.addPyFile(made)
        _SHIPPED.add(sc.applicationId)


def shipped(f: Callable) -> Callable:
    """f(spark, ...) after the package has been sent to the workers."""

    @functools.wraps(f)
    def run(spark: SparkSession, *args):
        ship(spark)
        return f(spark, *args)

    return run
