"""Streaming: the apply-side operators on Structured Streaming DataFrames."""
