"""Scans, list files and batch tables."""
