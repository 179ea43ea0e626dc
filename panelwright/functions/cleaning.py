"""Cleaning expressions. All are plain Columns, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Words read as true, and texts read as a missing category.
TRUE_WORDS = ["true", "1", "yes", "y"]
BLANK_WORDS = ["", "nan"]
UNKNOWN = "unknown"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double; unparsable text and NaN become null."""
    number = _col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def parse_bool(c: Column | str) -> Column:
    """Two-valued flag: a true word is true, everything else (null too) false."""
    return F.coalesce(F.lower(_col(c).cast("string")).isin(TRUE_WORDS), F.lit(False))


def fill_category(c: Column | str) -> Column:
    text = _col(c).cast("string")
    return F.when(text.isNull() | text.isin(BLANK_WORDS), F.lit(UNKNOWN)).otherwise(text)


def finite_or(c: Column | str, default: float = 0.0) -> Column:
    """Null, NaN and both infinities become ``default``."""
    number = _col(c).cast("double")
    bad = number.isNull() | F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(bad, F.lit(float(default))).otherwise(number)


def clip(c: Column | str, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null (``greatest`` alone would skip it)."""
    value = _col(c)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def safe_ratio(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """scale * a / b, null where b is 0 or null."""
    return F.try_divide(F.lit(float(scale)) * _col(numerator).cast("double"), _col(denominator).cast("double"))


def is_true(c: Column | str) -> Column:
    """Three-valued ``IS TRUE``; pushes to Parquet as a null-safe equality."""
    return _col(c).eqNullSafe(F.lit(True))


def has_flag(c: Column | str) -> Column:
    return _col(c).isNotNull().cast("int")


def cut(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (a, b]; values outside every bin are null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    value = _col(c)
    out: Column | None = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > F.lit(low)) & (value <= F.lit(high))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def first_match(pairs: Sequence[tuple[Column, str]], default: str) -> Column:
    """Ordered conditions to one code; a null condition counts as false."""
    out: Column | None = None
    for condition, code in pairs:
        out = F.when(condition, F.lit(code)) if out is None else out.when(condition, F.lit(code))
    return out.otherwise(F.lit(default))


def lookup(c: Column | str, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Literal dictionary lookup."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    hit = F.create_map(*pairs)[_col(c)]
    if default is None:
        return hit
    return F.coalesce(hit, default if isinstance(default, Column) else F.lit(default))


def codes_where(flags: Sequence[tuple[Column, str]]) -> Column:
    """Array of the codes whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(code)) for condition, code in flags]))


def join_codes(codes: Column, sep: str, empty: str) -> Column:
    return F.when(F.size(codes) > 0, F.concat_ws(sep, codes)).otherwise(F.lit(empty))


def short_handle(c: Column | str, prefix: str, tail: int) -> Column:
    """Readable pseudonym: prefix plus the last characters of the id."""
    return F.concat(F.lit(prefix), F.right(_col(c).cast("string"), F.lit(tail)))


def seeded_hash(c: Column | str, seed: int | str) -> Column:
    """Hex digest that stands in for a random draw: stable, engine-independent."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(c).cast("string")))
