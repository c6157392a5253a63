"""Delimited input and published snapshots."""
