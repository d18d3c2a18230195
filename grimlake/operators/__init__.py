"""Distributed operators: ranks and windows (``ranks``), skew-safe joins
(``joins``) and declarative data-quality checks (``quality``)."""
