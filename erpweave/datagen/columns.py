"""Value generators: every value is a function of (seed, table, column, row id).

Nothing depends on partitioning or on earlier rows, so a table of any size is one
parallel projection over row ids, a re-run gives the same rows, and a foreign key is
found by computing the parent's value again instead of joining the parent.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates fall in this window around a fixed day, so that output repeats.
BASE_DATE = "2025-06-30"
DAYS_BACK, DAYS_AHEAD = 730, 365


@dataclass(frozen=True)
class Place:
    """Where a value is generated: tables by name, table, column, row id, seed, scale."""

    tables: Mapping[str, Table]
    table: str
    column: str
    id: Column
    seed: int = 42
    scale: float = 1.0

    def hash(self, salt: str = "") -> Column:
        return F.xxhash64(F.lit(self.seed), F.lit(f"{self.table}.{self.column}.{salt}"), self.id)

    def uniform(self, salt: str = "") -> Column:
        """Uniform double in [0, 1) from 52 hash bits."""
        return F.shiftrightunsigned(self.hash(salt), 12) / F.lit(float(2**52))

    def pick(self, n: int, salt: str = "") -> Column:
        return F.pmod(self.hash(salt), F.lit(n))


class Generator:
    """Base of all generators; ``numeric`` ones are DOUBLE, the others STRING."""

    numeric = False

    def value(self, at: Place) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Constant(Generator):
    x: str

    def value(self, at: Place) -> Column:
        return F.lit(self.x)


@dataclass(frozen=True)
class Digits(Generator):
    """``n`` random digits, in pieces that fit a long."""

    n: int

    def value(self, at: Place) -> Column:
        pieces, left = [], self.n
        while left > 0:
            width = min(left, 18)
            piece = F.pmod(at.hash(f"d{left}"), F.lit(10**width)).cast("string")
            pieces.append(F.lpad(piece, width, "0"))
            left -= width
        return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def _array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


@dataclass(frozen=True)
class OneOf(Generator):
    choices: tuple[str, ...]

    def value(self, at: Place) -> Column:
        return F.element_at(_array(self.choices), (at.pick(len(self.choices)) + 1).cast("int"))


@dataclass(frozen=True)
class Weighted(Generator):
    """Weighted choice of a text, NULL or another generator."""

    choices: tuple[tuple[int, str | Generator | None], ...]

    def value(self, at: Place) -> Column:
        total = sum(w for w, _ in self.choices)
        u, reached, result = at.uniform("w"), 0, None
        for weight, choice in self.choices[:-1]:
            reached += weight
            test = u < F.lit(reached / total)
            value = self._of(choice, at)
            result = F.when(test, value) if result is None else result.when(test, value)
        last = self._of(self.choices[-1][1], at)
        return last if result is None else result.otherwise(last)

    @staticmethod
    def _of(choice: str | Generator | None, at: Place) -> Column:
        return choice.value(at) if isinstance(choice, Generator) else F.lit(choice).cast("string")


@dataclass(frozen=True)
class Cycle(Generator):
    sequence: tuple[str, ...]

    def value(self, at: Place) -> Column:
        return F.element_at(_array(self.sequence), (F.pmod(at.id, F.lit(len(self.sequence))) + 1).cast("int"))


@dataclass(frozen=True)
class Uniform(Generator):
    low: float
    high: float
    decimals: int = 2
    numeric = True

    def value(self, at: Place) -> Column:
        return F.round(F.lit(float(self.low)) + at.uniform() * (self.high - self.low), self.decimals)


@dataclass(frozen=True)
class Normal(Generator):
    """Gaussian by the Box-Muller transform, never below zero."""

    mean: float
    sd: float
    decimals: int = 2
    numeric = True

    def value(self, at: Place) -> Column:
        radius = F.sqrt(F.log(F.lit(1.0) - at.uniform("r")) * -2.0)
        z = radius * F.cos(at.uniform("a") * (2 * math.pi))
        return F.round(F.greatest(F.lit(0.0), F.lit(float(self.mean)) + z * float(self.sd)), self.decimals)


@dataclass(frozen=True)
class Date(Generator):
    pattern: str = "yyyyMMdd"

    def value(self, at: Place) -> Column:
        day = F.date_add(F.lit(BASE_DATE).cast("date"), (at.pick(DAYS_BACK + DAYS_AHEAD + 1) - DAYS_BACK).cast("int"))
        if self.pattern == "yyyyMMdd":
            return F.date_format(day, self.pattern)
        second = F.timestamp_seconds(at.pick(86400, "s"))
        return F.date_format(second, self.pattern)


_WORDS = {
    "company": (("Alfa", "Beta", "Norte", "Sul", "Litoral", "Serra", "Vale", "Porto"),
                ("Quimica", "Comercio", "Plasticos", "Logistica", "Alimentos", "Metais"), ("Ltda", "SA", "ME")),
    "person": (("Ana", "Bruno", "Carla", "Diego", "Elisa", "Fabio", "Gilda", "Hugo"),
               ("Almeida", "Barros", "Cardoso", "Dias", "Esteves", "Freitas", "Gomes")),
    "first": (("Ana", "Bruno", "Carla", "Diego", "Elisa", "Fabio", "Gilda", "Hugo"),),
    "last": (("Almeida", "Barros", "Cardoso", "Dias", "Esteves", "Freitas", "Gomes"),),
    "product": (("Resina", "Filme", "Granulado", "Solvente", "Aditivo", "Fibra"),
                ("Leve", "Premium", "Industrial", "Verde", "Especial")),
    "city": (("Aurora", "Campo Alto", "Lagoa", "Monte Claro", "Rio Bonito", "Santa Luz", "Vila Nova"),),
    "word": (("base", "carga", "dado", "etapa", "fluxo", "grupo", "item", "lote", "nota", "prazo"),),
}


@dataclass(frozen=True)
class Text(Generator):
    """Readable text from small word lists."""

    kind: str

    def value(self, at: Place) -> Column:
        words = [
            F.element_at(_array(part), (at.pick(len(part), f"t{i}") + 1).cast("int"))
            for i, part in enumerate(_WORDS[self.kind])
        ]
        return words[0] if len(words) == 1 else F.concat_ws(" ", *words)


@dataclass(frozen=True)
class Lookup(Generator):
    """A column of a parent row chosen by hash.

    Lookups of one table that share a ``group`` read the same parent row, so a pair of
    reference columns points at a document item that exists. Without a group every
    column draws its own parent row.
    """

    parent: str
    source: str
    group: str | None = None

    def value(self, at: Place) -> Column:
        parent = at.tables[self.parent]
        chooser = Place(at.tables, at.table, self.group or at.column, at.id, at.seed, at.scale)
        row = chooser.pick(parent.count(at.scale), "fk")
        return parent.columns[self.source].value(
            Place(at.tables, self.parent, self.source, row, at.seed, at.scale)
        )

    def is_numeric(self, tables: Mapping[str, Table]) -> bool:
        return is_numeric(tables[self.parent].columns[self.source], tables)


@dataclass(frozen=True)
class Table:
    """A table to generate: rows at scale 1 and its columns."""

    name: str
    rows: int
    columns: Mapping[str, Generator] = field(hash=False)

    def count(self, scale: float = 1.0) -> int:
        return max(1, round(self.rows * scale))

    def parents(self) -> set[str]:
        return {g.parent for g in self.columns.values() if isinstance(g, Lookup)}


def is_numeric(generator: Generator, tables: Mapping[str, Table]) -> bool:
    return generator.is_numeric(tables) if isinstance(generator, Lookup) else generator.numeric
