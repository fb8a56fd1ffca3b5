"""Structured Streaming entry points of the per-row operators."""
