"""Session settings, the shared folder and tables written between stages."""

from __future__ import annotations

import atexit
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "gleaner", **extra: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | extra
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Gives the package to the executors' Python workers, once a session: they need not have it on their path."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        here = pathlib.Path(__file__).resolve().parent
        target = pathlib.Path(tempfile.mkdtemp(prefix="gleaner-")) / "gleaner.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(here.rglob("*.py")):
                z.write(f, f.relative_to(here.parent))
        sc.addPyFile(str(target))
        _SHIPPED.add(sc.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session; on one machine, where it is unset, a new local one."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        now = sc._jsc.sc().getCheckpointDir()
        if not now.isDefined() and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = now.get() if now.isDefined() else tempfile.mkdtemp(prefix="gleaner-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(base)
    return base


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """The rows of df from a table in the shared folder: cuts the lineage and survives lost executors.

    The table is removed when the driver ends. An empty df keeps its schema."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gleaner/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    _REMOVE.append(path)
    return spark.read.schema(df.schema).parquet(path)


_REMOVE: list[str] = []


def spread(df: DataFrame) -> DataFrame:
    """df on all cores, for work in Python: an input of fewer partitions than cores is small and is repartitioned."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def free_shuffles(spark: SparkSession) -> None:
    """Lets the driver drop shuffle files of finished stages that nothing refers to any more."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


@atexit.register
def _remove_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or not _REMOVE:
        return
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _REMOVE:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except Exception:  # the session may be gone already
        pass
