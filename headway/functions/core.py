"""Small expression helpers shared by the other function modules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_RANGE = 4294967296  # hashes lie in [0, 2**32)


def half_even(value: Column, digits: int) -> Column:
    """Round half to even after scaling. `round` and `bround` both disagree with this on doubles."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def ratio(part: Column, whole: Column) -> Column:
    """Null instead of an error when the divisor is 0."""
    return F.try_divide(part, whole)


def first_match(rules: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """The value of the first rule that holds. A null condition counts as not matched."""
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def nan_to_null(value: Column) -> Column:
    """NaN sorts above every number in Spark, so thresholds would match it."""
    return F.nanvl(value, F.lit(None).cast("double"))


def keep_null(value: Column, bounded: Column) -> Column:
    """`greatest`/`least` skip nulls; this keeps a null input null."""
    return F.when(value.isNotNull(), bounded)


def trimmed(value: Column, default: str = "Unknown") -> Column:
    return F.trim(F.coalesce(value, F.lit(default)))


def whole_number(value: Column) -> Column:
    """Text or number to int; unparseable, missing or beyond an int becomes 0 ('3.0' counts as 3)."""
    parsed = nan_to_null(value.try_cast("double"))
    return F.coalesce(parsed.try_cast("int"), F.lit(0))


def hash_multiplier(seed: int) -> int:
    """An odd factor below 2**32. Each seed has its own, so different seeds order keys differently."""
    return (2654435761 + 2 * 1640531527 * seed) % HASH_RANGE | 1


def portable_hash(key: Column, seed: int) -> Column:
    """Multiplicative hash in [0, 2**32), the same in any SQL engine with 64-bit integers.

    Both halves of the key count, and products stay below 2**63, so ANSI mode cannot overflow.
    """
    wide = key.cast("bigint")
    low, high = wide.bitwiseAND(F.lit(2147483647)), F.shiftrightunsigned(wide, 31)
    mixed = low * F.lit(hash_multiplier(seed)) % F.lit(HASH_RANGE)
    more = high % F.lit(2147483647) * F.lit(hash_multiplier(seed + 1)) % F.lit(HASH_RANGE)
    return (mixed + more + F.lit(seed)) % F.lit(HASH_RANGE)


def draw_of(key: Column, copy: Column, seed: int) -> Column:
    """Hash in [0, 2**32) of a key and the number of one of its copies, however many there are."""
    return portable_hash(portable_hash(key, seed) + copy * F.lit(HASH_RANGE), seed + 100)


def of_type(schema: T.StructType, *kinds: type) -> list[str]:
    """Names of the columns whose type is one of `kinds`."""
    return [field.name for field in schema.fields if isinstance(field.dataType, kinds)]
