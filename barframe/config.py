"""Fixed values, defaults and the session helper.

Every function in the library takes and returns DataFrames and never creates a
session itself; ``session()`` is for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------

# Feature order of a price bar (index 0..4).
FEATURES = ("open", "close", "low", "high", "volume")

# Categories a model can target; ALL means the five features together.
CATEGORIES = ("OPEN", "CLOSE", "LOW", "HIGH", "VOLUME", "ALL")

# Display names of the five per-feature result series.
SERIES_NAMES = {
    "open": "Stock OPEN Price",
    "close": "Stock CLOSE Price",
    "low": "Stock LOW Price",
    "high": "Stock HIGH Price",
    "volume": "Stock VOLUME Amount",
}

# Names of the two chart series.
PREDICT_SERIES = "Predicts"
ACTUAL_SERIES = "Actuals"

# Month-day holidays, valid for any year.
HOLIDAYS = ("01-01", "01-05", "02-19", "03-30", "05-28", "07-04", "09-03", "11-22", "12-25")

# Forecast horizons in trading days, in payload order.
HORIZONS = (("week", 5), ("month", 20), ("trimestre", 60), ("year", 240), ("max", 1200))

# Window length, prediction length, mini-batch size, split ratios, seeds.
WINDOW = 22
HORIZON = 1
MINI_BATCH = 64
SERIES_SPLIT = 0.9
RANDOM_SPLIT = 0.6
SEED = 1234
EPOCHS = 100
L2 = 1e-4

# Chart bound factors.
CHART_LOW = 0.98
CHART_HIGH = 1.02

# First candidate trading day is as_of + this many days.
FIRST_OFFSET_DAYS = 2

# Classifier settings.
MLP_MAX_ITER = 100
MLP_BLOCK = 128
PRICE_MLP_HIDDEN = (64, 32, 16)
PRICE_CLASSES = 1000
PRICE_CLASS_WIDTH = 1.0

# Column layouts of the two bar CSV files.
LAYOUT_1 = ("date", "symbol", "open", "close", "low", "high", "volume")
LAYOUT_2 = ("symbol", "date", "open", "high", "low", "close", "volume")

# Stored document fields, positional record order.
RECORD_FIELDS = ("date", "open", "high", "low", "close", "volume", "id")

# ---------------------------------------------------------------------------
# Engine defaults (ours, not the reference's).
# ---------------------------------------------------------------------------

# Rows per window block: a series longer than this is cut into blocks that
# carry WINDOW + HORIZON overlap rows, so no single task holds a whole series.
BLOCK_ROWS = 1 << 14

# Calendar bucket used to index a series without a whole-series sort.
INDEX_BUCKET = "month"


def session(master: str | None = None, shuffle_partitions: int | None = None,
            app: str = "barframe") -> SparkSession:
    """Build (or get) a session with the settings the library is tuned for."""
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("BARFRAME_MASTER")
    if master:  # else spark-submit's, or Spark's own default
        builder = builder.master(master)
    parts = shuffle_partitions or int(os.environ.get("BARFRAME_SHUFFLE_PARTITIONS", "2000"))
    shared = os.environ.get("BARFRAME_SHARED_DIR")
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BARFRAME_DRIVER_MEMORY", "16g"))
        # Cluster sizing: start wide (adaptive execution merges partitions but never adds any) and let it
        # coalesce to ~128 MB partitions;
        # scan splits of 256 MB keep task counts sane on 100 TB inputs.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", os.environ.get("BARFRAME_MAX_PARTITION_BYTES", "256m"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session. Where it is unset, a session
    that runs in this process alone (local mode) gets a temporary folder of its
    own; on a cluster that would be one machine's disk, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="barframe-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # noqa: BLE001 - some deployments refuse runtime core confs
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
