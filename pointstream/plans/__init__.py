"""Whole queries: the driver tables as telemetry, and what runs over them."""
