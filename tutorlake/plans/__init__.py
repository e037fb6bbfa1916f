"""The batch jobs from raw logs to reports, each writing repeat-safe tables."""
