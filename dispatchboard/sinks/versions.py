"""Result versions of a micro-batch sink.

A version is the folder ``<path>/v=<batch_id>``; it counts once its marker
``<path>/_committed/<batch_id>`` exists, written after Spark's write returned (our own
marker, so clusters that switch off the writer's ``_SUCCESS`` file work the
same). One listing of the markers' folder tells all committed versions and
their ages, so readers and commits make the same few file-system calls
however many versions are kept. A commit removes versions that were
superseded more than ``retain`` seconds ago, so a reader has that long to
finish, and storage holds that long's results. A replayed batch takes its
marker away and rewrites its own folder; meanwhile readers see the version
before it, which is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Seconds a superseded version stays, so that a reader that has started on it
# can finish. The newest two stay in any case.
RETAIN_SECONDS = 6 * 3600
KEEP = 2
_PREFIX = "v="
_MARKERS = "_committed"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Remove a part that a sink wrote."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _marks(spark: SparkSession, path: str) -> dict[int, int]:
    """Commit time, in milliseconds, of every committed version under ``path``."""
    fs, root = _fs(spark, f"{path.rstrip('/')}/{_MARKERS}")
    if not fs.exists(root):
        return {}
    return {int(st.getPath().getName()): st.getModificationTime() for st in fs.listStatus(root)
            if st.getPath().getName().isdigit()}


def committed(spark: SparkSession, path: str) -> list[int]:
    """Batch ids of the committed versions under ``path``, ascending."""
    return sorted(_marks(spark, path))


def latest(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    ids = [v for v in committed(spark, path) if below is None or v < below]
    return ids[-1] if ids else None


def version_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{_PREFIX}{batch_id:020d}"


def read_latest(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    v = latest(spark, path, below)
    return None if v is None else spark.read.parquet(version_path(path, v))


def commit(df: DataFrame, path: str, batch_id: int, retain: float = RETAIN_SECONDS) -> None:
    """Write ``df`` as version ``batch_id``, then drop the committed versions
    that a newer one replaced more than ``retain`` seconds ago, all but the
    newest ``KEEP``."""
    spark = df.sparkSession

    def marker(v: int):
        return _fs(spark, f"{path.rstrip('/')}/{_MARKERS}/{v:020d}")
    fs, own = marker(batch_id)
    fs.delete(own, False)  # of an earlier attempt
    df.write.mode("overwrite").parquet(version_path(path, batch_id))
    fs.create(own, True).close()
    made = _marks(spark, path)
    ids = sorted(made)
    for old, newer in zip(ids[:-KEEP], ids[1:]):
        if made[batch_id] - made[newer] >= retain * 1000:
            fs.delete(marker(old)[1], False)
            remove(spark, version_path(path, old))
