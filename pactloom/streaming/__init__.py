"""Structured Streaming jobs: file arrivals and drift messages."""
