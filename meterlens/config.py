"""Domain constants and session helpers."""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Topic and zone names, rule thresholds, severity labels and their order.
# ---------------------------------------------------------------------------
TOPIC = "energy_readings"
SEVERITY_LABELS = ("NONE", "LOW", "MEDIUM", "HIGH")
RULE_COLUMNS = (
    "rule_low_consumption",
    "rule_voltage_spike",
    "rule_power_inconsistency",
    "rule_odd_hour_spike",
    "rule_frequency_anomaly",
)
FRAUD_LABEL = "⚠ FRAUD"
OK_LABEL = "OK"
Z_LABELS = ("EXTREME_ANOMALY", "MILD_ANOMALY", "NORMAL")
IQR_LABELS = ("BELOW_IQR_FENCE", "ABOVE_IQR_FENCE")
RISK_BANDS = ("red", "orange", "green")


@dataclass(frozen=True)
class Thresholds:
    """All tunable numbers of the rule set; defaults are the reference's."""

    low_consumption_kwh: float = 0.30
    voltage_max_v: float = 245.0
    power_ratio_max: float = 1.15
    night_hour_start: int = 0
    night_hour_end: int = 5
    night_consumption_kwh: float = 5.0
    freq_min_hz: float = 49.8
    freq_max_hz: float = 50.2
    interval_per_hour: int = 30  # 2-minute interval: kWh -> W factor x30 x1000
    # rolling-baseline rules (declared in the reference, applied by B3)
    low_consumption_ratio: float = 0.20
    spike_ratio: float = 3.5
    night_multiplier: float = 2.0
    current_imbalance_ratio: float = 1.15
    # statistical scoring
    z_mild: float = 2.0
    z_extreme: float = 3.0
    iqr_factor: float = 1.5
    day_change_pct: float = 30.0
    risk_red_pct: float = 30.0
    risk_orange_pct: float = 10.0
    weekly_sigma: float = 3.0


DEFAULT_THRESHOLDS = Thresholds()

# Stream settings of the reference job.
TRIGGER_INTERVAL = "30 seconds"
WATERMARK_DELAY = "10 minutes"
LIVE_MAX_MESSAGES = 2500
LIVE_RECENT_ROWS = 450
LIVE_ALERT_ROWS = 40

# Largest number of rows we allow to be broadcast by ``plans.joins``.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000


def session(app: str = "meterlens", master: str | None = None,
            shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings every operator assumes.

    UTC session time, AQE with skew-join splitting, no UI.  On a cluster the
    master and shuffle width come from spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.parquet.compression.codec", "snappy")
          .config("spark.sql.parquet.mergeSchema", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 split_bytes: int = 256 << 20, shuffle_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a large cluster run, derived from the input size.

    * file splits of ``split_bytes`` (column-pruned Parquet reads are a
      fraction of that on disk), so a 100 TB scan is ~400k tasks;
    * the heaviest shuffle here moves narrow rows (rolling baseline: key,
      time, kWh; about a tenth of the input), so AQE starts from enough
      partitions for ``shuffle_bytes`` each and coalesces small ones;
    * skew-join splitting for hot meters, RocksDB state for the stateful
      stream, and a broadcast limit that ``plans.joins.join_small`` reads.
    """
    heaviest_shuffle = input_bytes // 10
    initial = max(total_cores * 3, -(-heaviest_shuffle // shuffle_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, bench) without the setting gets a
    private scratch folder; a cluster session without it is an error, since a
    machine-local folder would not survive executor loss.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    d = tempfile.mkdtemp(prefix="meterlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d
