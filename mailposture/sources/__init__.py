"""Scans and sinks: raw answers, typed tables, registries, exports."""
