"""Scalar column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event codes of the unified event log.
PLAY, DOWNLOAD, SEARCH = "P", "D", "S"
EVENT_CODES = (PLAY, DOWNLOAD, SEARCH)

# Right-closed rating bins (0,10]->1 (10,20]->2 (20,30]->3
# (30,40]->4 (40,34285]->5; counts above the last edge also get 5.
RATING_EDGES = (10, 20, 30, 40)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_blanks(c: Column | str) -> Column:
    """Strip leading/trailing white space of any kind (U+00A0 and U+3000 too), like str.strip()."""
    return F.regexp_replace(_c(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def to_bigint(c: Column | str) -> Column:
    """Integer test/parse of a stripped string; null when not an integer."""
    return strip_blanks(c).try_cast("bigint")


def to_double(c: Column | str) -> Column:
    return strip_blanks(c).try_cast("double")


def hash_fraction_key(c: Column | str, salt: str, modulus: int = 10000) -> Column:
    """Deterministic per-key draw in [0, modulus): md5 of key||salt, first 32 bits.

    Independent of partitioning and of the run, so a sample or split drawn
    from it is repeatable and can be applied row-wise on any table keyed by
    the same id, without a join.
    """
    h = F.conv(F.substring(F.md5(F.concat(_c(c).cast("string"), F.lit(salt))), 1, 8), 16, 10)
    return F.pmod(h.cast("bigint"), F.lit(modulus))


def in_hash_sample(c: Column | str, ratio: float, salt: str = "", modulus: int = 10000) -> Column:
    """keep a key when its draw is below ratio*modulus."""
    return hash_fraction_key(c, salt, modulus) < F.lit(int(round(ratio * modulus)))


def rating_bin(c: Column | str) -> Column:
    """Right-closed bins of a positive count into 1..5 (not Bucketizer, which is left-closed)."""
    c = _c(c)
    e1, e2, e3, e4 = RATING_EDGES
    return (F.when(c <= 0, None)
            .when(c <= e1, 1).when(c <= e2, 2).when(c <= e3, 3).when(c <= e4, 4)
            .otherwise(5).cast("int"))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """Division that gives null (not an error) for a zero or null denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def nan_to_zero(c: Column | str) -> Column:
    """NaN or null -> 0."""
    return F.coalesce(F.nanvl(_c(c), F.lit(0.0)), F.lit(0.0))


def dot(a: Column | str, b: Column | str) -> Column:
    """R2: dot product of two equal-length array<double> columns."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def device_type(device: Column | str) -> Column:
    """P7: 'ip' -> 1, anything else (null included) -> 2."""
    return F.when(_c(device) == "ip", 1).otherwise(2).cast("int")
