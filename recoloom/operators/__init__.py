"""User-level operators: each is ``DataFrame(s) -> DataFrame``."""
