"""Deterministic hash expressions that DuckDB can reproduce (for oracle checks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bigint(*parts: Column | str, seed: int | str = 42) -> Column:
    """First 60 bits of md5('p1|p2|..|seed') as a non-negative bigint."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    s = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("bigint")


def md5_sql(*parts: str, seed: int | str = 42) -> str:
    """The same value in DuckDB SQL."""
    inner = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + f" || '|{seed}'"
    return f"CAST('0x' || substr(md5({inner}), 1, 15) AS BIGINT)"


def _large_primes(count: int = 8, below: int = 2 ** 31) -> list[int]:
    """The ``count`` largest primes below ``below`` (rule-built stride table)."""
    out, n = [], below - 1
    while len(out) < count:
        if n % 2 and all(n % d for d in range(3, int(n ** 0.5) + 1, 2)):
            out.append(n)
        n -= 1
    return out


STRIDE_PRIMES = _large_primes()
