"""Scans and sources: event log, progress fixture, usage, sensors, tables."""
