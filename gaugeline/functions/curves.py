"""Space-filling order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def interleaved(values: Sequence[Column], bits: int) -> Column:
    """The low bits of some whole numbers in turn, the highest of the first one first. Rows that are
    near each other in this order are near in all values (Morton, 1966)."""
    if bits * len(values) > 63:
        raise ValueError("more bits than a long has")
    taken = []
    for place in range(bits):
        for number, value in enumerate(reversed(values)):
            bit = F.shiftright(value.cast("long"), place).bitwiseAND(F.lit(1).cast("long"))
            taken.append(F.shiftleft(bit, place * len(values) + number))
    return reduce(lambda a, b: a.bitwiseOR(b), taken)
