"""Joins, sinks, audits and calendar operators."""
