"""Thresholds and defaults the operators share.

Fixed values: these are the numbers the pipeline guides state, kept here as
plain text so every operator uses the same ones.

- heartbeat age: under 90 seconds healthy, under 180 seconds warning, else critical
- consumer lag alert: above 5000 messages
- stalled consumer: lag has not fallen for 10 minutes and lag above 100
- dropped-row rate alert: above 0.01 of output rows
- quality rule alert: failure percentage above 1.0
- reconciliation failure: count difference above 100 or max-id gap above 10
- skewed partitions: largest partition above 5 times the median
- runtime skew split: skewedPartitionFactor 5, skewedPartitionThresholdInBytes 256 MB
- empty-batch streak: 3 empty batches in a row
- clustering-key score weights: frequency 0.4, cardinality 0.2, correlation 0.2, skew 0.1, gain 0.1
- clustering-key cardinality bounds: 10 to 100 000 000 distinct values, inclusive
- obsolete-file retention: 168 hours unless explicitly overridden
- retention advice: fewer than 100 files -> 30 days, monthly; fewer than 1000 -> 14 days, bi-weekly;
  otherwise 7 days, weekly
- compaction target: about 1 GB per file; post-write compaction: 128 MB files
- partition sizing: at least 1 GB per partition, alert at 10 000 files
- per-file statistics: first 32 columns
"""

HEARTBEAT_HEALTHY_S = 90
HEARTBEAT_WARNING_S = 180
LAG_ALERT = 5000
LAG_STUCK_MINUTES = 10
LAG_STUCK_MIN = 100
DROP_RATE_ALERT = 0.01
QUALITY_ALERT_PCT = 1.0
RECONCILE_MAX_COUNT_DIFF = 100
RECONCILE_MAX_ID_GAP = 10
SKEW_FACTOR = 5.0
AQE_SKEW_FACTOR = "5"
AQE_SKEW_THRESHOLD = "256MB"
EMPTY_BATCH_RUN = 3
CLUSTER_SCORE_WEIGHTS = {"frequency": 0.4, "cardinality": 0.2, "correlation": 0.2, "skew": 0.1, "gain": 0.1}
CLUSTER_NDV_BOUNDS = (10, 100_000_000)
VACUUM_RETAIN_HOURS = 168
RETENTION_RULES = ((100, 30, "monthly"), (1000, 14, "bi-weekly"), (None, 7, "weekly"))
COMPACT_TARGET_BYTES = 1 << 30
AUTO_COMPACT_TARGET_BYTES = 128 << 20
PARTITION_MIN_BYTES = 1 << 30
PARTITION_MAX_FILES = 10_000
