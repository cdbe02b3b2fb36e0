"""Column-level helpers. All of them build JVM-side expressions (no UDFs)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's behaviour.
# Label text accepted as the positive class (after trimming whitespace).
POSITIVE_LABEL_TEXT = ["1", "是", "Y", "y", "True", "true", "yes"]
# Month key given to rows whose time is null.
NULL_MONTH = "NaT"

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)
TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def fround(col: Column, digits: int) -> Column:
    """Round half away from zero on ``col * 10^digits`` (the usual SQL engine rule).

    Spark's ``round`` on doubles rounds the shortest decimal string, which differs
    from ``round(x * 10^d) / 10^d`` on values like 0.00015. All metrics use this
    helper so that results are reproducible in other SQL engines.
    """
    scale = float(10 ** digits)
    return F.round(col.cast("double") * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def as_metric_value(col: Column, dtype: T.DataType) -> Column:
    """Numeric view of a feature: NaN is missing (as in pandas), booleans are 0 / 1,
    dates become epoch seconds."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    if isinstance(dtype, NUMERIC_TYPES):
        return col.cast("double")
    if isinstance(dtype, T.BooleanType):
        return col.cast("int").cast("double")
    if isinstance(dtype, T.DateType):
        return (F.unix_date(col).cast("double") * F.lit(86400.0))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return order_number(col, dtype).cast("double") / F.lit(1e6)
    raise TypeError(f"no numeric view for {dtype.simpleString()}")


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES + (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def classify_type(dtype: T.DataType) -> str:
    """numeric / categorical / time / other, by data type."""
    if isinstance(dtype, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dtype, TEXT_TYPES):
        return "categorical"
    if isinstance(dtype, TIME_TYPES):
        return "time"
    return "other"


def order_number(col: Column, dtype: T.DataType) -> Column:
    """A numeric key with the same order as ``col`` (exact, no time zone involved).

    Used where ranks are computed by counting (splits, order statistics).
    """
    if isinstance(dtype, T.TimestampNTZType):
        micros_of_second = (F.date_part(F.lit("SECOND"), col) * F.lit(1_000_000)).cast("long")
        return (F.unix_date(F.to_date(col)).cast("long") * F.lit(86_400_000_000)
                + (F.hour(col) * F.lit(3600) + F.minute(col) * F.lit(60)).cast("long") * F.lit(1_000_000)
                + micros_of_second)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    if isinstance(dtype, NUMERIC_TYPES):
        if isinstance(dtype, T.DecimalType):
            return col.cast("double")      # statistics only; the exact keys are in ``order_numbers``
        return col.cast("long")
    if isinstance(dtype, T.BooleanType):
        return col.cast("long")
    raise TypeError(f"cannot order by {dtype.simpleString()}")


TEXT_CHUNK = 6   # bytes of a text key in one number
LIMB = 10 ** 13  # a decimal's whole part is cut into numbers below this
EXACT_SCALE = 32


def _decimal_keys(col: Column, dtype: T.DecimalType) -> list[Column]:
    """Whole part (floor) in limbs, highest first, then the decimal places as one or two numbers."""
    whole, keys = F.floor(col).cast("decimal(38,0)"), []
    for _ in range(2 if dtype.precision - dtype.scale > 18 else 0):
        low = F.pmod(whole, F.lit(LIMB).cast("decimal(14,0)"))
        keys.insert(0, low.cast("long"))
        whole = ((whole - low) / F.lit(LIMB).cast("decimal(14,0)")).cast("decimal(38,0)")
    keys.insert(0, whole.cast("long"))
    if not dtype.scale:
        return keys
    if dtype.scale > EXACT_SCALE:
        raise TypeError(f"cannot order exactly by {dtype.simpleString()}: more than {EXACT_SCALE} decimal places")
    places = F.pmod(col, F.lit(1).cast("decimal(1,0)"))
    scaled = (places * F.lit(Decimal(10 ** dtype.scale)).cast(f"decimal({dtype.scale + 1},0)")).cast("decimal(38,0)")
    if dtype.scale <= 18:
        return [*keys, scaled.cast("long")]
    unit = F.lit(Decimal(10 ** 16)).cast("decimal(17,0)")
    low = F.pmod(scaled, unit)
    return [*keys, ((scaled - low) / unit).cast("decimal(38,0)").cast("long"), low.cast("long")]


def order_numbers(col: Column, dtype: T.DataType, longest: int = 0) -> list[Column]:
    """Numeric keys that, compared one after the other, order as ``col`` does.

    A text (of at most ``longest`` bytes) is cut into chunks of six bytes, each
    read as a big-endian number followed by its length, so a shorter text comes
    first; the order is the one of the UTF-8 bytes, which is the code-point order.
    A decimal gives its whole part and its places as exact integers.
    """
    if isinstance(dtype, T.DecimalType):
        return _decimal_keys(col, dtype)
    if not isinstance(dtype, TEXT_TYPES):
        return [order_number(col, dtype)]
    raw = col.cast("string").cast("binary")
    keys = []
    for i in range(0, max(longest, 1), TEXT_CHUNK):
        part = F.substring(raw, i + 1, TEXT_CHUNK)
        code = F.conv(F.rpad(F.hex(part), 2 * TEXT_CHUNK, "0"), 16, 10).cast("long")
        keys.append(code * F.lit(8) + F.length(part))
    return keys


def label_binary(col: Column, dtype: T.DataType) -> Column:
    """0/1 label. Text: trimmed value in the positive list. Numbers: equal to 1.

    Null and unknown values give 0, as in the reference.
    """
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit(1)).otherwise(F.lit(0))
    if isinstance(dtype, NUMERIC_TYPES):
        return F.when(col.cast("double") == F.lit(1.0), F.lit(1)).otherwise(F.lit(0))
    text = F.regexp_replace(col.cast("string"), r"^\s+|\s+$", "")
    return F.when(text.isin(*POSITIVE_LABEL_TEXT), F.lit(1)).otherwise(F.lit(0))


def month_key(col: Column) -> Column:
    """'yyyy-MM' of a date/time column; null time gives 'NaT'."""
    return F.coalesce(F.date_format(col, "yyyy-MM"), F.lit(NULL_MONTH))
