from muster.sources import snapshots, tables

__all__ = ["snapshots", "tables"]
