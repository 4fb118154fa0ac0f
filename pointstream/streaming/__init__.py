"""Streaming jobs and their settings."""
