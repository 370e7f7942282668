"""Batch and streaming analytics operators written on the Spark DataFrame API."""
