"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator,
each paired (where SQL can express it) with an independent DuckDB oracle."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import features, store, training, retrieval, serving, documented, encoding, models, streams  # noqa: F401,E402
