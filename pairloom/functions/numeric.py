"""Integer arithmetic, stable losses and hash-based uniform draws."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def idiv(value: Column | str, divisor: int) -> Column:
    """Integer division that stays BIGINT (``/`` would go through DOUBLE)."""
    return F.call_function("div", as_col(value), F.lit(divisor).cast("bigint"))


def softplus(x: Column) -> Column:
    """ln(1 + e^x) without overflow; the plain form turns into NULL for large |x|."""
    return F.when(x > 0, x + F.log1p(F.exp(-x))).otherwise(F.log1p(F.exp(x)))


def pair_loss(chosen: Column | str, rejected: Column | str) -> Column:
    """-ln sigmoid(chosen - rejected)."""
    return softplus(as_col(rejected) - as_col(chosen))


def pair_win(chosen: Column | str, rejected: Column | str) -> Column:
    """1.0 when chosen is strictly above rejected, 0.0 otherwise (NULL when either is)."""
    c, r = as_col(chosen), as_col(rejected)
    return F.when(c > r, F.lit(1.0)).when(c <= r, F.lit(0.0))


def seeded_hash(key: Column | str, seed: int, *more: Column | str) -> Column:
    """md5 hex of ``key|seed|more...``: the same order on every run and engine."""
    parts = [as_col(key).cast("string"), F.lit(str(seed))]
    parts += [as_col(c).cast("string") for c in more]
    return F.md5(F.concat_ws("|", *parts))


def hash_uniform(hex_digest: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of a hex digest."""
    head = F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("double")
    return head / F.lit(4294967296.0)


def dot(vector: Column | str, weights: Column, bias: float = 0.0) -> Column:
    """w.h + b over an array column, in DOUBLE; NULL for a NULL vector."""
    products = F.zip_with(as_col(vector), weights, lambda h, w: h.cast("double") * w)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x) + F.lit(float(bias))


def literal_vector(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def money(value: Column | str, digits: int) -> Column:
    """A number as text with fixed decimals, rounded the same way in every engine."""
    return F.round(as_col(value), digits).cast(f"decimal(18,{digits})").cast("string")
