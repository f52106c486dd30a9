"""Workforce analytics on Spark: snapshots, scorecards, history events, document compliance."""
