"""Point telemetry on Spark: decode, messages, lookup enrichment and ledgers."""

__version__ = "0.1.0"
