"""Records as the cells of a wide-column row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CELL_FAMILY, CELL_QUALIFIERS


def complete(columns: Sequence[str] = tuple(CELL_QUALIFIERS)) -> Column:
    """True when no cell would hold a null, which a keyed store cannot take."""
    condition = F.col(columns[0]).isNotNull()
    for column in columns[1:]:
        condition = condition & F.col(column).isNotNull()
    return condition


def cell_struct(qualifiers: Mapping[str, str] = CELL_QUALIFIERS) -> Column:
    """One family as a struct, a field per qualifier."""
    return F.struct(*[F.col(column).alias(name) for column, name in qualifiers.items()])


def cell_rows(
    rows: DataFrame,
    keep: Sequence[str],
    qualifiers: Mapping[str, str] = CELL_QUALIFIERS,
    family: str = CELL_FAMILY,
) -> DataFrame:
    """One row ``(*keep, family, qualifier, value)`` per cell."""
    cells = [
        F.struct(
            F.lit(family).alias("family"),
            F.lit(name).alias("qualifier"),
            F.col(column).alias("value"),
        )
        for column, name in qualifiers.items()
    ]
    return rows.select(*keep, F.inline(F.array(*cells)))
