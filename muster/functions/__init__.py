from muster.functions import dates, predicates, text

__all__ = ["dates", "predicates", "text"]
