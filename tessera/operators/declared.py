"""What the metadata declares, in the form the operators take.

These are small values on the driver: one project's keys, edges, measures and
column hints.  Their size depends on the model, never on the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Relationship:
    """Edge with parallel key columns; the from-side holds the foreign key."""

    from_table: str
    to_table: str
    from_columns: tuple[str, ...]
    to_columns: tuple[str, ...]
    cardinality: str = "one_to_many"

    def __post_init__(self) -> None:
        if not self.from_columns or len(self.from_columns) != len(self.to_columns):
            raise ValueError("key column lists must be of equal length and not empty")


@dataclass(frozen=True)
class Measure:
    name: str
    formula: str
    definition: str = ""


@dataclass(frozen=True)
class Scd:
    """History columns of a table."""

    valid_from: str | None = None
    valid_to: str | None = None
    is_current_flag: str | None = None


@dataclass(frozen=True)
class ColumnHint:
    name: str
    classification: str = "unspecified"
    expression: str | None = None
    tags: Sequence[str] = field(default=())
