"""Code -> label mapping and fallbacks, generated as CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from layercake.functions._util import ColumnOrName, col, lit_or_col, trim_spaces

_NORMALIZERS = {
    None: lambda c: c,
    "trim": trim_spaces,
    "upper": F.upper,
    "upper_trim": lambda c: F.upper(trim_spaces(c)),
}


def map_codes(
    c: ColumnOrName,
    mapping: Mapping[str, str],
    default: object = "n/a",
    *,
    normalize: str | None = None,
    null_as: str | None = None,
) -> Column:
    """Map codes to labels, like ``CASE WHEN key IN (codes of label) THEN label ...
    ELSE default END``.

    * ``mapping`` -- ``{code: label}``; several codes may share a label.
    * ``normalize`` -- None (exact match), "trim", "upper" or "upper_trim" applied
      to the input before matching.
    * ``default`` -- literal or Column used when nothing matches (NULL input
      included, unless ``null_as`` is given); evaluated only for those rows.
    * ``null_as`` -- label for NULL input.

    The lookup goes through a constant map, so the normalized key is computed
    once per row (a CASE chain would recompute it for every branch it tests).
    """
    c = col(c)
    if not mapping:
        mapped: Column = F.lit(None).cast("string")
    else:
        table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
        mapped = F.try_element_at(table, _NORMALIZERS[normalize](c))
    result = F.coalesce(mapped, lit_or_col(default))
    if null_as is not None:
        result = F.when(c.isNull(), F.lit(null_as)).otherwise(result)
    return result


def fallback(
    primary: ColumnOrName,
    secondary: ColumnOrName,
    unknown: Sequence[str] = ("n/a",),
    default: str = "n/a",
) -> Column:
    """Keep ``primary`` unless it is one of ``unknown`` (or NULL); else
    ``coalesce(secondary, default)``."""
    p = col(primary)
    known = p != F.lit(unknown[0]) if len(unknown) == 1 else ~p.isin(list(unknown))
    return F.when(known, p).otherwise(F.coalesce(col(secondary), F.lit(default)))
