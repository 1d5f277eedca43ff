"""recoloom — set-oriented recommendation and feature analytics on Spark DataFrames.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built from the
DataFrame / SQL API, so Catalyst and AQE plan it; the few order-dependent or
vector-heavy steps use Arrow-batched ``applyInPandas`` / ``mapInPandas``.
"""

__version__ = "0.1.0"
