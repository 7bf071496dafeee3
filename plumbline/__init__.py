"""plumbline: event ingest, quality checks, drift measurement and model retraining on Spark."""
