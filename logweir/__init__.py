"""Network-log analytics on Spark: enrichment, sliding metrics, anomalies, alerts."""
