"""Column expressions: time handling, clipping, rounding, ratios, hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_OFFSET_HOURS = 8
EPOCH = "1970-01-01 00:00:00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_local(epoch: Column | str, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """Epoch seconds as naive local time, independent of the session time zone."""
    seconds = _col(epoch).cast("bigint") + offset_hours * 3600
    return F.timestamp_add("SECOND", seconds, F.lit(EPOCH).cast("timestamp_ntz"))


def sentinel_null(value: Column | str, sentinel: int = -1) -> Column:
    return F.nullif(_col(value), F.lit(sentinel))


def safe_time(text: Column | str, fmt: str = "yyyyMMddHHmmss") -> Column:
    """Parse a compact time; anything malformed becomes null."""
    return F.try_to_timestamp(_col(text), F.lit(fmt)).cast("timestamp_ntz")


def day_ceil(time: Column | str) -> Column:
    """Day label of a time rounded up to midnight; exact midnight stays on its own date."""
    just_before = F.timestamp_add("MICROSECOND", F.lit(-1), _col(time))
    return F.date_add(just_before.cast("date"), 1)


def midnight(day: Column | str) -> Column:
    return _col(day).cast("date").cast("timestamp_ntz")


def existing_time(day: Column | str, create_time: Column | str) -> Column:
    """Seconds an ad has existed at the start of ``day``; null for an unknown creation time."""
    return F.timestamp_diff("SECOND", _col(create_time), midnight(day)).cast("double")


def clip_low(value: Column | str, floor: float = 1.0) -> Column:
    """Lower bound that keeps null (``greatest`` alone would replace it) and NaN."""
    v = _col(value)
    return F.when(v.isNotNull(), F.greatest(v.cast("double"), F.lit(float(floor))))


def round_half_even(value: Column | str) -> Column:
    return F.rint(_col(value))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    return F.try_divide(_col(numerator), _col(denominator))


def not_nan(value: Column | str) -> Column:
    """NaN as null, so that missing has one form only."""
    v = _col(value).cast("double")
    return F.when(~F.isnan(v), v)


SPREAD_RANGE = 2147483648  # exclusive bound of ``spread``
SPREAD_FOLD, SPREAD_MIX, SPREAD_SALT = 1540483477, 73244475, 2654435769  # odd multipliers


def spread(key: Column | str, salt: int = 0) -> Column:
    """Pseudo-random integer in [0, 2^31) from an integer key, in arithmetic any SQL engine has.

    Shifts and multiplications mix all bits of the key with the salt, so values under
    different salts are independent of each other. Keys of one block of 2^31 get
    different values.
    """
    k = _col(key).cast("bigint")
    whole = F.lit(SPREAD_RANGE).cast("bigint")
    high = F.pmod(F.pmod(F.shiftright(k, 31), whole) * SPREAD_FOLD, whole)
    x = F.pmod(k, whole).bitwiseXOR(high).bitwiseXOR(F.lit(salt * SPREAD_SALT % SPREAD_RANGE).cast("bigint"))
    for _ in range(2):
        x = F.pmod(x.bitwiseXOR(F.shiftright(x, 15)) * SPREAD_MIX, whole)
    return x.bitwiseXOR(F.shiftright(x, 15))


def blend_fixed(tree_fm: Column | str, tree: Column | str, net: Column | str,
                outer: float = 0.65, inner: float = 0.7,
                multiplier: Column | None = None) -> Column:
    """outer * tree_fm + (1 - outer) * (inner * tree + (1 - inner) * net), optionally scaled."""
    # Complements are taken in decimal so that 1 - 0.65 is the literal 0.35.
    rest, rest_inner = round(1 - outer, 12), round(1 - inner, 12)
    mixed = outer * _col(tree_fm) + rest * (inner * _col(tree) + rest_inner * _col(net))
    return mixed if multiplier is None else mixed * multiplier
