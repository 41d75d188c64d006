"""Snapshots from files as they arrive."""
