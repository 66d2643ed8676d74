"""Session helpers: reliable checkpoints in the folder the cluster names."""

from __future__ import annotations

import atexit
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir`` of the session; a local folder only where none is set."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="quakespark-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quakespark-{kind}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, and the reader starts with real sizes for its join choices and
    without the constraints of the old plan, which grow from round to round in iterative jobs. Shuffle files of the
    making are dropped with it: nothing reads them again, and they would lie on disk until the driver collects garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    if _PASSING:
        _PASSING[-1].append(table)
    return table


_PASSING: list[list[DataFrame]] = []


@contextmanager
def passing_tables() -> Iterator[None]:
    """Tables that ``checkpointed`` makes inside are deleted at the end: what leaves has to be collected or written elsewhere."""
    made: list[DataFrame] = []
    _PASSING.append(made)
    try:
        yield
    finally:
        _PASSING.remove(made)
        for table in made:
            discard(table)


def discard(table: DataFrame) -> None:
    """Delete a table of ``checkpointed`` that nothing reads any more, so that the folder does not grow with the steps of a loop."""
    sc = table.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, whatever folder they run in."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parent
    folder = tempfile.TemporaryDirectory(prefix="quakespark-ship-")  # the driver serves the file from here
    path = pathlib.Path(folder.name) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(path))
    atexit.register(folder.cleanup)
    _SHIPPED.add(sc.applicationId)


def local_session(cores: str = "8", app: str = "quakespark", **conf: str) -> SparkSession:
    """A ``local[...]`` session with the settings used by the tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark
