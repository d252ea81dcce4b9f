"""Whole jobs made of operators: refresh, loads, reports, snapshots."""
