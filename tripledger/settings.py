"""Settings read once from the environment, and the session built from them."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tripledger import fixed_values as fv


def _env(name: str, default: str | None = None):
    return field(default_factory=lambda: os.environ.get(name, default))


@dataclass(frozen=True)
class Settings:
    """Where the data lives. Keys have no built-in default: they come from the environment."""

    kafka_servers: str = _env("KAFKA_BOOTSTRAP_SERVERS", "localhost:29092")
    s3_endpoint: str | None = _env("S3_ENDPOINT_URL")
    s3_access_key: str | None = _env("S3_ACCESS_KEY")
    s3_secret_key: str | None = _env("S3_SECRET_KEY")
    raw_root: str = _env("RAW_ROOT", "s3a://raw")
    features_root: str = _env("FEATURES_ROOT", "s3a://fraud-features")
    reconciled_root: str = _env("RECONCILED_ROOT", "s3a://reconciled")
    large_amount: float = fv.LARGE_AMOUNT
    burst_count: int = field(
        default_factory=lambda: int(os.environ.get("FRAUD_BURST_COUNT", fv.BURST_COUNT))
    )
    burst_seconds: int = field(
        default_factory=lambda: int(os.environ.get("FRAUD_BURST_WINDOW_SECONDS", fv.BURST_SECONDS))
    )

    def object_store_conf(self) -> dict[str, str]:
        """Hadoop settings for an S3-compatible store; empty without an endpoint."""
        if not self.s3_endpoint:
            return {}
        conf = {
            "spark.hadoop.fs.s3a.endpoint": self.s3_endpoint,
            "spark.hadoop.fs.s3a.path.style.access": "true",
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        }
        if self.s3_access_key and self.s3_secret_key:
            conf["spark.hadoop.fs.s3a.access.key"] = self.s3_access_key
            conf["spark.hadoop.fs.s3a.secret.key"] = self.s3_secret_key
        return conf


# Shuffle width, file split size and memory stay with the cluster: AQE coalesces and splits.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose shuffled partitions all turn out this small are hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_session_conf(spark: SparkSession) -> None:
    """The same settings on a session somebody else built; all of them may change at run time."""
    for name, value in SESSION_CONF.items():
        spark.conf.set(name, value)


def build_session(app: str, settings: Settings | None = None, streaming: bool = False) -> SparkSession:
    settings = settings or Settings()
    conf = {**SESSION_CONF, **settings.object_store_conf(), **(STREAM_CONF if streaming else {})}
    builder = SparkSession.builder.appName(app)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
