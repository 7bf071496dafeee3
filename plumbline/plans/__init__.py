"""The seven jobs: ingest, stage, validate, drift, retrain, score and page.  Each module has a ``main``."""
