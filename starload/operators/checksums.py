"""A checksum of a set of rows that does not depend on their order or on how they are split."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMB_BITS = 16
LIMBS = [f"sum_{k}" for k in range(128 // LIMB_BITS)]
"""A row's 128-bit hash in parts, each summed by itself in a long, which holds for 2^47 rows: partial sums of
tasks and folders add up."""


def limb_sums(fields: Iterable[T.StructField]) -> list[Column]:
    """Aggregates over the named columns of rows, to be given to ``checksum``.

    Equal values give equal sums whatever the width of their integers, and a null differs from every value.
    """
    said = []
    for f in fields:
        value = F.col(f.name).cast("bigint") if isinstance(f.dataType, T.IntegralType) else F.col(f.name)
        said += [value.isNull(), value]
    halves = [F.xxhash64(F.lit(k), *said) for k in (1, 2)]
    mask = F.lit((1 << LIMB_BITS) - 1).cast("bigint")
    parts = [F.shiftrightunsigned(h, low).bitwiseAND(mask) for h in halves for low in range(0, 64, LIMB_BITS)]
    return [F.coalesce(F.sum(p), F.lit(0)).alias(name) for name, p in zip(LIMBS, parts)]


def checksum(*sums: Row | dict) -> str:
    """The sum of all rows' hashes modulo 2^128, from the limb sums of one or several sets of rows."""
    total = sum(s[name] << (LIMB_BITS * k) for s in sums for k, name in enumerate(LIMBS))
    return f"{total % (1 << 128):032x}"


def added(checksums: Sequence[str]) -> str:
    """The checksum of several sets together."""
    return f"{sum(int(c, 16) for c in checksums) % (1 << 128):032x}"
