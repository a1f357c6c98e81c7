"""Packet telemetry on Spark: ingest, shape, store, query and reconcile packet tables."""
