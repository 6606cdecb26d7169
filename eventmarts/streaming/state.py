"""Settings that jobs with keyed state need while they start."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SETTINGS = {
    # Keyed state with time-to-live lives in this store; it spills to the executors' disks and is
    # saved under the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Expired state is dropped with the next data; a drain would else never find its end.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep these settings for their whole life; the session gets its own back."""
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
