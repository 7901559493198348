"""Operators: silver parsing, gold metrics, alerts, quality, maintenance."""
