"""The shape of an entity table: one row per tested unit, one column per measured feature."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EntitySpec:
    """Names of the key columns and the label coding of an entity table."""

    id: str = "entity_id"
    ts: str = "test_timestamp"
    label: str = "yield_label"
    outcome: str = "pass_fail"
    prefix: str = "feature_"
    fail_value: int = 1
    pass_value: int = -1

    @property
    def keys(self) -> list[str]:
        return [self.id, self.ts, self.label, self.outcome]

    def measured(self, df: DataFrame) -> list[str]:
        """Features by exclusion: every column that is not a key column, in column order."""
        return [c for c in df.columns if c not in self.keys]

    def prefixed(self, df: DataFrame) -> list[str]:
        """Features by name prefix, in column order."""
        return [c for c in df.columns if c.startswith(self.prefix)]

    def failed(self) -> Column:
        return F.col(self.label) == self.fail_value

    def passed(self) -> Column:
        return F.col(self.label) == self.pass_value

    def y(self) -> Column:
        """Label encoding: 1 for the fail value, 0 for everything else, missing labels included."""
        return F.coalesce(self.failed(), F.lit(False)).cast("int")

    def date(self) -> Column:
        return F.to_date(F.col(self.ts))


DEFAULT_SPEC = EntitySpec()
