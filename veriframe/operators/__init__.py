"""Computed containers and fields, profiles, rules, scans, anomalies, registry."""
