from muster.operators import aggregates, filters, joins, lookups, ordered, ranks, rules, scorecard

__all__ = ["aggregates", "filters", "joins", "lookups", "ordered", "ranks", "rules", "scorecard"]
