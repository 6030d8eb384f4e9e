"""Chains of named steps: a generic step builder, the step registry with its categories, and stage tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equi_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "inner") -> DataFrame:
    """A join on pairs of column names; null keys meet nothing.  A right key of another name goes with ``left_semi`` and ``left_anti`` only."""
    right = right.withColumnsRenamed({b: f"_r_{b}" for _, b in on})
    test = reduce(lambda x, y: x & y, [F.col(a) == F.col(f"_r_{b}") for a, b in on])
    out = left.join(right, test, how)
    return out if how in ("left_semi", "left_anti") else out.withColumnsRenamed({f"_r_{b}": b for a, b in on if b not in left.columns}).drop(*[f"_r_{b}" for _, b in on if b in left.columns])


def build_step(
    df: DataFrame,
    select: Sequence[Column | str] | None = None,
    replace: dict[str, Column] | None = None,
    distinct: bool = False,
    joins: Sequence[tuple[DataFrame, Sequence[tuple[str, str]], str]] = (),
    where: Sequence[Column] = (),
    final: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One step of a chain: joins, filters, then a column list or replaced columns, distinct or not; or a free final step.

    A column list and replaced columns exclude each other.
    """
    if select and replace:
        raise ValueError("a step either selects columns or replaces some")
    for other, on, how in joins:
        df = equi_join(df, other, on, how)
    for test in where:
        df = df.where(test)
    df = df.select(*select) if select else df.withColumns(replace) if replace else df
    df = df.distinct() if distinct else df
    return final(df) if final else df


def final_columns(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    """The columns that are marked ``final``, under their aliases, distinct."""
    return df.select(*[F.col(c["name"]).alias(c.get("alias", c["name"])) for c in columns if c.get("final")]).distinct()


@dataclass
class Step:
    """A registered step: its function gets the frame and, if it has categories, the category."""

    name: str
    run: Callable[..., DataFrame]
    categories: tuple[str, ...] = ()


@dataclass
class Registry:
    """Steps by name, and the stage that each category has come to.

    An empty result ends a category: its stage number turns negative, and later
    steps skip it.  Every stage of a category is kept by number until
    :meth:`cleanup`.
    """

    steps: dict[str, Step] = field(default_factory=dict)
    stage: dict[str, int] = field(default_factory=dict)
    tables: dict[tuple[str, int], DataFrame] = field(default_factory=dict)

    def register(self, name: str, run: Callable[..., DataFrame], categories: Sequence[str] = ()) -> None:
        self.steps[name] = Step(name, run, tuple(categories))

    def categories(self, name: str) -> tuple[str, ...]:
        return self.steps[name].categories

    def start(self, category: str, df: DataFrame) -> None:
        self.stage[category] = 0
        self.tables[category, 0] = df

    def current(self, category: str) -> DataFrame:
        return self.tables[category, abs(self.stage[category])]

    def run(self, name: str, category: str) -> DataFrame | None:
        """Run a step on a category's current stage; None where the category has ended or the step is not for it."""
        step = self.steps[name]
        if self.stage.get(category, 0) < 0 or (step.categories and category not in step.categories):
            return None
        df = self.current(category)
        out = step.run(df, category) if step.categories else step.run(df)
        number = self.stage[category] + 1
        self.tables[category, number] = out
        self.stage[category] = -number if out.isEmpty() else number
        return out

    def run_all(self, names: Sequence[str]) -> dict[str, DataFrame]:
        for name in names:
            for category in list(self.stage):
                self.run(name, category)
        return {c: self.current(c) for c in self.stage}

    def cleanup(self, category: str) -> int:
        """Forget all stages of a category, of one that has ended, too; returns how many there were."""
        numbers = [n for c, n in self.tables if c == category]
        for n in numbers:
            self.tables.pop((category, n)).unpersist()
        self.stage.pop(category, None)
        return len(numbers)
