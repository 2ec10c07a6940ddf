"""Session settings and the shared checkpoint folder."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State memory per process, and the share of it given to write buffers.
STATE_MEMORY_MB = 3000
STATE_WRITE_BUFFER_RATIO = 0.1

STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MEMORY_MB),
    "spark.sql.streaming.stateStore.rocksdb.writeBufferCacheRatio": str(STATE_WRITE_BUFFER_RATIO),
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution and the bounded state store.

    Partition counts are left to the cluster's own settings; pass them in ``conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        **STATE_STORE_CONF,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed processors need, for queries started here and no others."""
    before = {name: spark.conf.get(name, None) for name in STATE_STORE_CONF}
    for name, value in STATE_STORE_CONF.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder: on a cluster the executors would not see it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="soleprint-")
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return named or current
