"""Metadata-driven conforming, identity resolution and metrics for Spark."""
