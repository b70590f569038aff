"""Spark jobs that keep tables in step across systems: change logs, diffs, merges, lineage and audits."""
