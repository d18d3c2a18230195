"""Column helpers (``exprs``) and the fixed rule tables (``rules``)."""

from grimlake.functions import exprs, rules

__all__ = ["exprs", "rules"]
