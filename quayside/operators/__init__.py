"""Data operators: alignment, load validation, quality, profiling, reconciliation,
anomaly detection, lineage."""
