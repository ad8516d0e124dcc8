"""Session helpers: build a session for tests/bench and locate the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


# Kernels run one per task slot: numpy's BLAS must not start its own thread pool in every
# Python worker (8 workers x 8 BLAS threads oversubscribes the cores several times over).
KERNEL_THREADS_ENV = {"OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1", "MKL_NUM_THREADS": "1"}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tidewise") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    for k, v in KERNEL_THREADS_ENV.items():
        os.environ.setdefault(k, v)
    builder = SparkSession.builder
    for k, v in KERNEL_THREADS_ENV.items():
        builder = builder.config(f"spark.executorEnv.{k}", v)
    spark = (
        builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEWISE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewise`` importable in the Python workers that run the grouped-map kernels.

    The package is zipped once per driver process and added with ``SparkContext.addPyFile``
    (Spark distributes it to every executor), once per application."""
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    if not _ZIP:
        root = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="tidewise-pkg-"), "tidewise.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        z.write(full, os.path.join("tidewise", os.path.relpath(full, root)))
        _ZIP.append(out)
    spark.sparkContext.addPyFile(_ZIP[0])
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` is read from the session; a folder set on the context comes next.
    Only a local master may fall back to a temporary folder (tests): on a cluster the executors
    would each write to a disk of their own, so a missing setting is an error there."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewise-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; it is set once, and only where it is unset."""
    return checkpoint_root(spark)


_RUN_FOLDERS: dict[str, SparkSession] = {}


def run_folder(spark: SparkSession) -> str:
    """This application's folder under the checkpoint root; removed when the driver ends."""
    path = f"{checkpoint_root(spark)}/tidewise-{spark.sparkContext.applicationId}"
    if path not in _RUN_FOLDERS:
        if not _RUN_FOLDERS:
            atexit.register(release_all)
        _RUN_FOLDERS[path] = spark
    return path


def release_all() -> None:
    """Delete the intermediate tables of every application of this driver that still runs."""
    for path, spark in list(_RUN_FOLDERS.items()):
        sc = spark.sparkContext
        if sc._jsc is not None and not sc._jsc.sc().isStopped():
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        del _RUN_FOLDERS[path]


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet once. The shuffle files of this write are deleted as soon as it has ended (the
    table is what later steps read), so a job of many steps holds the shuffles of one step at a time."""
    conf = df.sparkSession.conf
    before = conf.get(_SHUFFLE_CLEANUP, None)
    conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.unset(_SHUFFLE_CLEANUP) if before is None else conf.set(_SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder and read it back.

    One computation (``DataFrame.checkpoint`` evaluates the plan once for its count and again
    for the RDD checkpoint write), columnar on disk, and the re-read plan has no lineage, so a
    lost executor only costs re-reading files. Never ``localCheckpoint``.
    """
    import uuid

    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """The intermediate tables of one job in the shared checkpoint folder. ``drop`` deletes a table as soon as its
    last reader has been written; what is left goes with the run's folder when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        import uuid

        self.spark = spark
        self.folder = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            delete_folder(self.spark, f"{self.folder}/{name}")
