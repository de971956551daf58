"""Event-platform analytics on Spark: ingest, projections, sagas, serving reads and metrics as DataFrame operators."""

__version__ = "0.1.0"
