"""Structured Streaming job."""
