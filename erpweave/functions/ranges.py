"""Selection ranges: lists of include / exclude conditions on one field."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from erpweave.functions._cols import ColumnLike, as_col


@dataclass(frozen=True)
class SelectOption:
    """One range row. ``sign`` is I (include) or E (exclude)."""

    sign: str
    option: str
    low: object
    high: object = None

    def test(self, c: Column) -> Column:
        match self.option:
            case "EQ":
                return c == F.lit(self.low)
            case "NE":
                return c != F.lit(self.low)
            case "GT":
                return c > F.lit(self.low)
            case "GE":
                return c >= F.lit(self.low)
            case "LT":
                return c < F.lit(self.low)
            case "LE":
                return c <= F.lit(self.low)
            case "BT":
                return c.between(F.lit(self.low), F.lit(self.high))
            case "NB":
                return ~c.between(F.lit(self.low), F.lit(self.high))
            case "CP":
                # Pattern: * any text, + any one character.
                return c.like(str(self.low).replace("*", "%").replace("+", "_"))
        raise ValueError(f"unknown range option {self.option!r}")


def in_ranges(col: ColumnLike, options: list[SelectOption]) -> Column:
    """Any include row matches and no exclude row does; no rows means no restriction."""
    c = as_col(col)
    includes = [o.test(c) for o in options if o.sign == "I"]
    excludes = [o.test(c) for o in options if o.sign == "E"]
    accepted = reduce(lambda a, b: a | b, includes) if includes else F.lit(True)
    if not excludes:
        return accepted
    return accepted & ~reduce(lambda a, b: a | b, excludes)
