"""Human-readable counts and sizes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

QUANTITY_STEPS = ((1e12, " trillion"), (1e9, " billion"), (1e6, " million"), (1e3, " thousand"))
SIZE_STEPS = ((2**40, " TiB"), (2**30, " GiB"), (2**20, " MiB"), (2**10, " KiB"))


def _ladder(c: Column, steps, base_suffix: str) -> Column:
    out = None
    for scale, suffix in steps:
        text = F.format_string("%.2f" + suffix, c / F.lit(float(scale)))
        hit = c >= F.lit(float(scale))
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out.otherwise(F.format_string("%.2f" + base_suffix, c.cast("double")))


def readable_quantity(c: Column | str) -> Column:
    return _ladder(F.col(c) if isinstance(c, str) else c, QUANTITY_STEPS, "")


def readable_size(c: Column | str) -> Column:
    return _ladder(F.col(c) if isinstance(c, str) else c, SIZE_STEPS, " B")
