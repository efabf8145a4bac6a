"""What a caller adds to a rule or an aggregate: named measures of its own and a condition on its rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Extras:
    """``where`` is a condition on the input rows, NULL counting as no. ``measures`` become further output columns.

    Where the result has a row per transaction a measure is an expression over the transaction; where it has a row per
    group or tumbling window it is an aggregate over the group's rows; where windows slide, sums are put together from
    panes, so there a measure is an expression whose sum is taken. A name must not be one of the result's own.
    """

    measures: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None

    def rows(self, df: DataFrame) -> DataFrame:
        return df if self.where is None else df.where(self.where)

    def columns(self) -> list[Column]:
        return [c.alias(name) for name, c in self.measures.items()]

    def checked(self, result: DataFrame) -> DataFrame:
        """The result, if no measure has taken the name of another column."""
        twice = sorted({c for c in result.columns if result.columns.count(c) > 1})
        if twice:
            raise ValueError(f"measures named like columns of the result: {', '.join(twice)}")
        return result


NONE = Extras()
