"""A project of models: dependencies, materialisation, tests, and the runner that builds it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import Table

#: Days before the first day to write that an incremental model reads (FLT-4): of a daily series they
#: hold more than the 268 rows of the longest chain of measures.
LOOKBACK_DAYS = 500


@dataclass(frozen=True)
class Model:
    """``build(ref)`` gives the rows, in one of four kinds (SNK-9..11).

    A view is its plan; a table is written in full; an incremental model merges its rows by its keys;
    a snapshot's ``build(ref, before)`` gives its next state from the one before (None at first).
    ``by`` is the date column that parts and prunes it, ``cluster`` the order within its files.
    """

    name: str
    build: Callable
    kind: str = "view"
    keys: tuple[str, ...] = ()
    tests: tuple = ()
    by: str | None = None
    cluster: tuple[str, ...] = ()

    def table(self, spark: SparkSession, path: str) -> Table:
        return Table(spark, f"{path}/{self.name}", self.by if self.kind != "snapshot" else None, self.cluster)


@dataclass
class Outcome:
    """What a build did: violations by (model, test), and models that were not built."""

    violations: dict[tuple[str, str], int] = field(default_factory=dict)
    failed: set[str] = field(default_factory=set)
    skipped: set[str] = field(default_factory=set)


class Project:
    """Models by name, and sources: name -> callable() that gives a DataFrame.

    ``stage(name, rows)`` writes the rows of a model that a query reads more than once, those named in
    ``staged``, and gives them back. Tests named (model, test) in ``only_warn`` never fail a model.
    """

    def __init__(
        self,
        models: list[Model],
        sources: dict[str, Callable[[], DataFrame]],
        staged: tuple[str, ...] = (),
        stage: Callable[[str, DataFrame], DataFrame] | None = None,
        only_warn: frozenset[tuple[str, str]] = frozenset(),
    ):
        self.models = {m.name: m for m in models}
        self.sources = sources
        self.staged, self.stage, self.only_warn = staged, stage, only_warn
        self._built: dict[str, DataFrame] = {}
        self._reads: dict[str, set[str]] = {}

    def ref(self, name: str) -> DataFrame:
        """The lazy rows of a model or source; each plan is made once."""
        if name not in self._built:
            rows = self._plan(name, self.ref)
            if self.stage is not None and name in self.staged:
                rows = self.stage(name, rows)
            self._built[name] = rows
        return self._built[name]

    def _plan(self, name: str, ref: Callable[[str], DataFrame], before: DataFrame | None = None) -> DataFrame:
        model = self.models.get(name)
        if model is None:
            return self.sources[name]()
        reads = self._reads.setdefault(name, set())

        def inner(other: str) -> DataFrame:
            reads.add(other)
            return ref(other)

        return model.build(inner, before) if model.kind == "snapshot" else model.build(inner)

    def dependencies(self) -> dict[str, set[str]]:
        """What each model reads, found by planning it."""
        for name in self.models:
            self.ref(name)
        return {n: {r for r in self._reads[n] if r in self.models} for n in self.models}

    def order(self) -> list[str]:
        return list(TopologicalSorter(self.dependencies()).static_order())

    def build(self, spark: SparkSession, path: str, since: dt.date | None = None) -> Outcome:
        """Build all models in order, write tables, then test each; a failed model's children are skipped.

        With ``since``, the first day whose rows may have changed, incremental models that have been
        built before are computed from ``LOOKBACK_DAYS`` before it and write rows from that day on:
        only the partitions that hold them are read and written. A series without as many rows in the
        look-back as its longest measure needs a full build. A test of severity ``warn`` reports and
        never fails its model (DQ-8).
        """
        order, after = self.order(), self.dependencies()
        done = Outcome()
        self._built = {n: df for n, df in self._built.items() if n not in self.models}
        for name in order:
            model = self.models[name]
            if after[name] & (done.failed | done.skipped):
                done.skipped.add(name)
                continue
            table = model.table(spark, path)
            if model.kind == "view":
                self._built[name] = self._plan(name, self.ref)
            elif model.kind == "incremental" and since is not None and table.version():
                rows = self._plan(name, self._read_since(spark, path, since - dt.timedelta(LOOKBACK_DAYS)))
                table.merge(rows.filter(F.col(model.by) >= F.lit(since)), list(model.keys))
            elif model.kind == "snapshot":
                before = table.read() if table.version() else None
                table.replace(self._plan(name, self.ref, before))
            else:
                table.replace(self._plan(name, self.ref))
            if model.kind != "view":
                self._built[name] = table.read()
            self._test(model, self._built[name], done)
        return done

    def _read_since(self, spark: SparkSession, path: str, first: dt.date) -> Callable[[str], DataFrame]:
        """References of an incremental run: of dated tables only the partitions from ``first`` on."""

        def ref(name: str) -> DataFrame:
            model = self.models.get(name)
            if model is None or model.by is None:
                return self.ref(name)
            rows = self.ref(name) if model.kind == "view" else model.table(spark, path).read(since=first)
            return rows.filter(F.col(model.by) >= F.lit(first))

        return ref

    def _test(self, model: Model, rows: DataFrame, done: Outcome) -> None:
        """Tests of single rows are counted together, in one pass over the model."""
        single = [t for t in model.tests if t.where is not None]
        counts: dict[str, int] = {}
        if single:
            row = rows.agg(*[F.count_if(t.where()).alias(f"n{i}") for i, t in enumerate(single)]).first()
            counts = {t.name: row[i] for i, t in enumerate(single)}
        for test in model.tests:
            n = counts[test.name] if test.name in counts else test.violations(rows, self.ref).count()
            done.violations[model.name, test.name] = n
            if n and test.severity == "error" and (model.name, test.name) not in self.only_warn:
                done.failed.add(model.name)
