"""The model registry: queries by name, with their layer, tags, inputs and publishing."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import with_lineage
from ..functions.predicates import refresh_window


@dataclass(frozen=True)
class Context:
    """One run: which rows it refreshes, and the constants of its lineage columns.

    logical_date: None for a full rebuild.
    """

    logical_date: date | None = None
    days: int = 7
    run_id: str = "manual"
    built: str = "1970-01-01 00:00:00"
    full_history: bool = False
    latest_snapshot_only: bool = False

    @classmethod
    def now(cls, **values) -> Context:
        return cls(built=datetime.now().isoformat(sep=" ", timespec="seconds"), **values)

    def window(self, c: str) -> Column:
        return refresh_window(c, self.logical_date, self.days)


@dataclass(frozen=True)
class Model:
    """A query. Its inputs are the names of its function's parameters: bronze tables as b_<table>, or models."""

    name: str
    layer: str
    build: Callable[..., DataFrame]
    columns: str
    tags: frozenset[str] = frozenset()
    partition: str | None = None
    alias: str | None = None
    inputs: tuple[str, ...] = field(default=())
    upsert_keys: tuple[str, ...] = ()

    @property
    def lineage(self) -> str:
        return "gold" if self.layer == "gold" else "silver"


MODELS: dict[str, Model] = {}


def model(layer: str, columns: str, tags: Iterable[str] = (), partition: str | None = None, alias: str | None = None, keys: Iterable[str] = ()):
    """Register a function (ctx, input tables ...) as the model of its name, with its columns as "name type, ..."."""

    def add(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        inputs = tuple(inspect.signature(build).parameters)[1:]
        MODELS[build.__name__] = Model(build.__name__, layer, build, columns, frozenset({layer, *tags}), partition, alias, inputs, tuple(keys))
        return build

    return add


def fields(m: Model) -> list[tuple[str, str]]:
    """(name, type) of a model's business columns."""
    out = []
    for part in m.columns.replace(", ", "\n").split("\n"):
        name, kind = part.strip().split(" ", 1)
        out.append((name, kind))
    return out


def wide(kind: str) -> str:
    """A type for a column's values of whatever size; decimals keep their scale, and keys that come as int stay so."""
    return f"decimal(38,{kind.rpartition(',')[2]}" if kind.startswith("decimal") else "int" if kind == "smallint" else kind


def select(tags: Iterable[str] = (), names: Iterable[str] = (), excluded: Iterable[str] = ()) -> list[str]:
    """Models that have one of the tags or names, without those excluded, in order of their inputs."""
    wanted, tags, out = {*names}, {*tags}, {*excluded}
    return [n for n in ordered() if (n in wanted or tags & MODELS[n].tags or not (tags or wanted)) and n not in out and not out & MODELS[n].tags]


def ordered() -> list[str]:
    """All models, inputs first."""
    done: dict[str, None] = {}

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"models in a circle: {' > '.join((*path, name))}")
        if name not in done and name in MODELS:
            for i in MODELS[name].inputs:
                visit(i, (*path, name))
            done[name] = None

    for name in MODELS:
        visit(name, ())
    return [*done]


class Build:
    """Lazy tables of all models over bronze tables; shared ones are resolved once, so their plans are the same."""

    def __init__(self, sources: Mapping[str, DataFrame] | Callable[[str], DataFrame], ctx: Context | None = None, given: Mapping[str, DataFrame] | None = None):
        self.source = sources if callable(sources) else sources.__getitem__
        self.ctx, self.found = ctx or Context(), dict(given or {})

    def __call__(self, name: str) -> DataFrame:
        if name not in self.found:
            if name.startswith("b_"):
                self.found[name] = self.source(name.removeprefix("b_"))
            else:
                m = MODELS[name]
                self.found[name] = m.build(self.ctx, *(self(i) for i in m.inputs))
        return self.found[name]

    def materialise(self, name: str, table: bool = False) -> DataFrame:
        """A model as a view of its name; as a table it is kept once it has been computed."""
        df = self.published(name)
        self.found[name] = df.persist() if table else df
        self.found[name].createOrReplaceTempView(MODELS[name].alias or name)
        return self.found[name]

    def business(self, name: str) -> DataFrame:
        """A model's own columns, in its declared types."""
        return self(name).select(*(F.col(c).cast(kind).alias(c) for c, kind in fields(MODELS[name])))

    def values(self, name: str) -> DataFrame:
        """A model's own columns by value: rounded as declared, not bounded by the width of the declared types."""
        return self(name).select(*(F.col(c).cast(wide(kind)).alias(c) for c, kind in fields(MODELS[name])))

    def published(self, name: str) -> DataFrame:
        """A model's own columns with its run's lineage."""
        m = MODELS[name]
        return with_lineage(self.business(name), m.lineage, m.alias or m.name, self.ctx.run_id, self.ctx.built)
