"""Vector expressions on ``array<float|double>`` columns (SF-10..SF-12, SF-16, PRJ-8).

All are higher-order SQL functions (``zip_with`` / ``aggregate``), evaluated in
the JVM inside whole-stage codegen — no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def l2_squared(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double"))
                                  * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def l2(a, b) -> Column:
    return F.sqrt(l2_squared(a, b))


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; 0.0 when either side is missing, of different length or all-zero."""
    a, b = _c(a), _c(b)
    ok = a.isNotNull() & b.isNotNull() & (F.size(a) == F.size(b)) & (F.size(a) > 0)
    sim = F.try_divide(dot(a, b), norm(a) * norm(b))
    return F.when(ok, F.coalesce(sim, F.lit(0.0))).otherwise(F.lit(0.0))


def sparse_dot(a, b) -> Column:
    """Inner product of two sparse vectors (indices, values); 0.0 when either is missing.
    The entries of the shorter one are looked up in the other."""
    a, b = _c(a), _c(b)

    def of(short, long):
        other = lambda i: F.coalesce(F.get(long["values"], F.array_position(long["indices"], i).cast("int") - 1), F.lit(0.0))
        return F.aggregate(F.zip_with(short["indices"], short["values"], lambda i, v: v * other(i)), F.lit(0.0), lambda acc, v: acc + v)
    return F.when(a.isNull() | b.isNull(), 0.0).when(F.size(a["indices"]) <= F.size(b["indices"]), of(a, b)).otherwise(of(b, a))


def zero_impute(e, dim: int | Column) -> Column:
    """Keep vectors of the expected length, else a zero vector of that length."""
    e = _c(e)
    d = dim if isinstance(dim, Column) else F.lit(dim)
    return F.when(e.isNotNull() & (F.size(e) == d), e).otherwise(
        F.array_repeat(F.lit(0.0).cast("float"), d.cast("int")))


def modal_dim(df: DataFrame, col: str) -> Column:
    """Most frequent vector length (ties → larger), as a scalar subquery."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.size(col).alias("d")).count()
            .select(F.max_by("d", F.struct("count", "d"))).scalar())


def flatten(df: DataFrame, col: str, dim: int) -> DataFrame:
    """One column per dimension ``<col>_dim_<i>`` (SF-17 / E-5)."""
    return df.select(*[c for c in df.columns if c != col],
                     *[F.get(F.col(col), i).alias(f"{col}_dim_{i}") for i in range(dim)])


def mean_vector(df: DataFrame, group: list[str] | str, vec: str, out: str = "mean_vector") -> DataFrame:
    """Per-group element-wise mean of vectors (X-5) with MLlib's ``Summarizer``:
    an aggregate with map-side partial buffers (no per-dimension row blow-up)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    group = [group] if isinstance(group, str) else list(group)
    return (df.where(F.col(vec).isNotNull())
            .groupBy(*group).agg(Summarizer.mean(array_to_vector(F.col(vec))).alias("__m"))
            .select(*group, vector_to_array("__m").alias(out)))
