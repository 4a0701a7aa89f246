"""loglens: log anomaly and incident analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
sources    scans and sinks: log files, Kafka, parquet tables, derived fixtures
functions  column expressions: line parser, keywords, severity, text templates
operators  reusable DataFrame operators: feature counts, scalers, interval join,
           keep-first dedup, sequences, cooldown fold, clustering, forest, forecaster
plans      end-to-end jobs: detection, alerting, incidents, playbook
streaming  Structured Streaming wiring of the same operators
"""

__all__ = ["session", "schemas"]
