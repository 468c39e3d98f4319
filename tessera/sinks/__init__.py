"""Sinks: date-partitioned Parquet with dynamic overwrite and schema
conformance (audit documents are written by ``tessera.plans.run_metrics``)."""
