"""Operational-incident analytics on Spark: decode, classify, audit, load, check and report."""

from tidewarden.config import JobConfig, Thresholds, WireNames

__all__ = ["JobConfig", "Thresholds", "WireNames"]
