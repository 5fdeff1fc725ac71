"""Interleaved key over both country codes, for a layout that skips on either side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from pairpulse.config import EngineConfig


def code_id(cfg: EngineConfig, code: Column) -> Column:
    """Dense id of a focus country in alphabetical order; NULL outside the list."""
    codes = F.array(*[F.lit(c) for c in sorted(cfg.focus_countries)])
    return F.nullif(F.array_position(codes, code), F.lit(0)).cast("int") - 1


def z_key(cfg: EngineConfig, source: str = "Actor1CountryCode",
          target: str = "Actor2CountryCode") -> Column:
    """Bit i of the source id goes to bit 2i, bit i of the target id to bit 2i + 1."""
    bits = max(1, (len(cfg.focus_countries) - 1).bit_length())
    a, b = code_id(cfg, F.col(source)), code_id(cfg, F.col(target))

    def spread(value: Column, i: int, to: int) -> Column:
        return F.shiftleft(F.shiftright(value, i).bitwiseAND(F.lit(1)), to)

    parts = [spread(a, i, 2 * i).bitwiseOR(spread(b, i, 2 * i + 1)) for i in range(bits)]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)
