"""Micro-batch loading of the warehouse with Structured Streaming."""
