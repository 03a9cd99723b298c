"""Snapshot, diff, record and look up database-server permissions with Spark."""
