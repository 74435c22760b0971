"""Numeric column expressions whose results must not depend on evaluation
order or on the engine's rounding convention.

* ``scaled_round`` rounds the binary value (``round(x * 10^n) / 10^n``), so
  ``1.005`` -> ``1.0``; ``F.round`` would round the decimal text to ``1.01``.
* ``exact_sum`` / ``exact_mean`` sum fixed-point integers, so partial
  aggregates may combine in any order and still give the same bits. They are
  for inputs that carry at most ``scale`` decimals (sensor readings,
  prices); pass ``scale=None`` to get the plain floating ``sum``/``avg``.
* ``safe_corr`` returns NULL instead of raising when a column is constant.
* ``clean_double`` parses text to double only when it looks like a number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


_LOW = (1 << 20) - 1


def scaled_round(c: ColumnOrName, digits: int) -> Column:
    """Round half away from zero on the binary value, to ``digits`` decimals."""
    factor = float(10 ** digits)
    return F.round(_col(c) * F.lit(factor)) / F.lit(factor)


def fixed_point(c: ColumnOrName, scale: int = 2) -> Column:
    """The value times ``10^scale`` as a long (exact for <= ``scale`` decimals)."""
    return F.round(_col(c) * F.lit(float(10 ** scale))).cast("long")


def exact_sum(c: ColumnOrName, scale: int | None = 2) -> Column:
    """Aggregate: sum of the column; exact and order-independent when
    ``scale`` is given. The low 20 bits and the rest are summed apart, so a
    group of 8e12 rows fits whatever its values add up to."""
    if scale is None:
        return F.sum(_col(c))
    v = fixed_point(c, scale)
    high, low = F.sum(F.shiftright(v, 20)), F.sum(v.bitwiseAND(F.lit(_LOW)))
    return ((high.cast("decimal(28,0)") * F.lit(_LOW + 1) + low).cast("double")
            / F.lit(float(10 ** scale)))


def exact_mean(c: ColumnOrName, scale: int | None = 2) -> Column:
    """Aggregate: mean of the non-null values (NULL for none)."""
    if scale is None:
        return F.avg(_col(c))
    return F.try_divide(exact_sum(c, scale), F.count(_col(c)).cast("double"))


def sum_parts(c: str, scale: int | None = 2) -> list[Column]:
    """Aggregates that can be summed again exactly: ``c_hi`` and ``c_lo`` (the two
    halves of the fixed-point sum; with ``scale`` None a plain ``c_sum`` alone),
    ``c_n``, ``c_max`` and ``c_sum`` (as a double)."""
    v = F.col(c)
    out = [exact_sum(c, scale).alias(f"{c}_sum"), F.count(v).alias(f"{c}_n"),
           F.max(v).alias(f"{c}_max")]
    if scale is not None:
        fp = fixed_point(c, scale)
        out += [F.sum(F.shiftright(fp, 20)).alias(f"{c}_hi"),
                F.sum(fp.bitwiseAND(F.lit(_LOW))).alias(f"{c}_lo")]
    return out


def parts_sum(c: str, scale: int | None = 2, where: Column | None = None) -> Column:
    """Aggregate: the sum of ``c`` from its parts."""
    kept = (lambda x: F.when(where, F.col(x))) if where is not None else F.col
    if scale is None:
        return F.sum(kept(f"{c}_sum"))
    high, low = F.sum(kept(f"{c}_hi")), F.sum(kept(f"{c}_lo"))
    return ((high.cast("decimal(28,0)") * F.lit(_LOW + 1) + low).cast("double")
            / F.lit(float(10 ** scale)))


def parts_mean(c: str, scale: int | None = 2, where: Column | None = None) -> Column:
    """Aggregate: the mean of ``c`` from its parts."""
    n = F.col(f"{c}_n") if where is None else F.when(where, F.col(f"{c}_n"))
    return F.try_divide(parts_sum(c, scale, where), F.sum(n).cast("double"))


def weighted_sum(c: ColumnOrName, weight: ColumnOrName, scale: int | None = 2) -> Column:
    """Aggregate: the sum of ``c`` with each row counted ``weight`` times; exact
    with a ``scale``."""
    c, weight = _col(c), _col(weight)
    if scale is None:
        return F.sum(c * weight)
    v = fixed_point(c, scale)
    high, low = F.sum(F.shiftright(v, 20) * weight), F.sum(v.bitwiseAND(F.lit(_LOW)) * weight)
    return ((high.cast("decimal(28,0)") * F.lit(_LOW + 1) + low).cast("double")
            / F.lit(float(10 ** scale)))


def weighted_mean(c: ColumnOrName, weight: ColumnOrName, scale: int | None = 2) -> Column:
    """Aggregate: the mean of ``c`` over rows counted ``weight`` times."""
    n = F.sum(F.when(_col(c).isNotNull(), _col(weight))).cast("double")
    return F.try_divide(weighted_sum(c, weight, scale), n)


def safe_corr(y: ColumnOrName, x: ColumnOrName) -> Column:
    """Aggregate: Pearson correlation, NULL when either side has no variance."""
    y, x = _col(y), _col(x)
    both = F.when(y.isNotNull() & x.isNotNull(), F.lit(True))
    yy = F.when(both, y)
    xx = F.when(both, x)
    return F.try_divide(F.covar_pop(yy, xx), F.stddev_pop(yy) * F.stddev_pop(xx))


# Text that a numeric cast should accept: optional sign, digits with optional
# single underscores between them, optional fraction and exponent.
NUMERIC_TEXT = r"^\s*[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d+)?\s*$"


# Characters a plain number may contain (digits, point, signs, exponent mark,
# the whitespace a cast trims).
NUMBER_CHARS = "0123456789.+-eE \t\n\r\f\u000b"


def clean_double(c: ColumnOrName) -> Column:
    """Parse text to double; NULL for anything that is not plainly numeric
    (``'n/a'``, ``''``, ``'12d'``, hex). NaN/Infinity text is rejected as
    well: every caller range-filters afterwards, and those never pass a
    range.

    Fast path (no underscore): the text may only hold number characters,
    checked with ``translate`` (no regex); within that alphabet the cast
    accepts exactly the strings ``NUMERIC_TEXT`` accepts. Texts with an
    underscore take the regex, which allows single underscores between
    digits."""
    s = _col(c).cast("string")
    plain = F.when(F.translate(s, NUMBER_CHARS, "") == F.lit(""), s.try_cast("double"))
    grouped = F.when(s.rlike(NUMERIC_TEXT), F.regexp_replace(s, "_", "").try_cast("double"))
    return F.when(s.contains("_"), grouped).otherwise(plain)


def text_to_int(c: ColumnOrName) -> Column:
    """Text such as ``'25.6'`` to a rounded integer (26) instead of an error."""
    return F.round(clean_double(c)).cast("int")


def pct(part: ColumnOrName, whole: ColumnOrName, digits: int = 1) -> Column:
    """``100 * part / whole`` rounded; NULL when ``whole`` is 0."""
    return scaled_round(F.try_divide(_col(part).cast("double") * F.lit(100.0),
                                     _col(whole).cast("double")), digits)
