"""Outputs of batch and streaming DataFrames."""
