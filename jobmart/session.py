"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Row-level text work is bound by CPU, hence smaller input splits than the default.
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Model calls are slow and cost money: tolerate long tasks and never run one twice on purpose.
ENRICH_SETTINGS = SETTINGS | {
    "spark.network.timeout": "800s",
    "spark.executor.heartbeatInterval": "60s",
    "spark.speculation": "false",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "120",
}

BYTES_PER_SHUFFLE_PARTITION = 512 * 1024 ** 2


def sized(input_bytes: int) -> dict[str, str]:
    """Shuffle partitions for an input of this size; adaptive execution merges what is too fine.

    Choose it before a stream's first start: its state keeps the number of partitions for good.
    """
    wanted = max(200, -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION))
    return {"spark.sql.shuffle.partitions": str(wanted)}



def session(name: str, settings: dict[str, str] | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | (settings or {}) | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh directory name below the cluster's shared checkpoint folder.

    Only where no such folder is configured and the master is local, as in tests, a local one is used.
    """
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"jobmart-{purpose}-")
