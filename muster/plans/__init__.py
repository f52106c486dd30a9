"""Domain plans: dated snapshots, history events, scorecards and document compliance.

Each plan reads its inputs from a mapping of table names to DataFrames and takes the run date.
"""
