"""Session helpers: table access, the shared folder, and lineage cuts.

Everything that must outlive an executor is written as Parquet into the folder named by
``spark.checkpoint.dir``. That folder is shared on a cluster; only when the setting is absent
(tests, notebooks) a folder below the local temporary directory is used, and only by a local master.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOT: list[str] = []
_WRITTEN: dict[str, SparkSession] = {}


def session(app: str = "lamina", **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for: AQE on, UTC, Arrow."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or a local folder where it is unset; raises where executors run elsewhere."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="lamina-"))
    return "file://" + _LOCAL_ROOT[0]


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it. Runs one job.

    Unlike a cached frame the result survives the loss of any executor, and the plan behind it is
    computed once however often it is read.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lamina-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._lamina_path = path  # type: ignore[attr-defined]
    return out


def release(df: DataFrame | None) -> None:
    """Delete what :func:`cut` wrote, once nothing reads it any more."""
    path = getattr(df, "_lamina_path", None)
    if path and _WRITTEN.pop(path, None) is not None:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone already; the folder is scratch space
        pass


@atexit.register
def _sweep() -> None:
    for path, spark in list(_WRITTEN.items()):
        _delete(spark, path)
    _WRITTEN.clear()
    import shutil

    for root in _LOCAL_ROOT:
        shutil.rmtree(root, ignore_errors=True)


def current_rows(df: DataFrame, keys: list[str], fields: dict[str, object], order: str = "loaded_at", first: str | None = None) -> DataFrame:
    """The current version of each key: the row with the greatest ``order``.

    ``fields`` maps output names to columns of ``df``. One aggregation with map-side combine, so a
    key with very many versions is reduced before the shuffle and never gathers in one task. Rows
    whose keys are all null are dropped, a null ``order`` loses against any value, and tied rows
    are taken to be identical. ``first`` adds the smallest ``order`` of the key under that name.
    """
    packed = F.struct(F.col(order).alias("_order"), *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()])
    known = df.where(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull())
    aggs = [F.max(packed).alias("_row")] + ([F.min(order).alias(first)] if first else [])
    out = known.groupBy(*keys).agg(*aggs)
    return out.select(*keys, F.col("_row._order").alias(order), *[F.col(f"_row.{n}").alias(n) for n in fields], *([first] if first else []))
