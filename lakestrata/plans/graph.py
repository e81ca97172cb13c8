"""Models that read each other: run in the order of their sources, with their lineage as a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from lakestrata.plans.models import run_model
from lakestrata.sources.readers import Sources

# What became of a model.
BUILT, FAILED, SKIPPED = "built", "failed", "skipped"
#: The group under which a model names another one as its source.
MODELS = "model"


@dataclass(frozen=True)
class Model:
    """A model, and the (group, table) relations it reads; other models are ("model", name).

    ``options`` are those of ``run_model``: how and where it is kept.
    """

    name: str
    reads: tuple[tuple[str, str], ...]
    build: Callable[[Sources], DataFrame]
    layer: str | None = None
    options: Mapping[str, object] = field(default_factory=dict)

    @property
    def parents(self) -> list[str]:
        return [table for group, table in self.reads if group == MODELS]


@dataclass(frozen=True)
class GraphRun:
    """What became of each model, in the order they were taken, and why some failed."""

    states: dict[str, str]
    errors: dict[str, Exception]

    def raise_failures(self) -> None:
        if self.errors:
            raise ExceptionGroup(f"failed: {', '.join(self.errors)}", list(self.errors.values()))


def run_order(models: Sequence[Model]) -> list[str]:
    """The models' names, each behind all that it reads; unknown parents and circles are refused."""
    known = {model.name: model for model in models}
    if len(known) < len(models):
        raise ValueError("two models have one name")
    for model in models:
        unknown = [parent for parent in model.parents if parent not in known]
        if unknown:
            raise ValueError(f"{model.name} reads {', '.join(unknown)}, which is no model")
    graph = {name: sorted(model.parents) for name, model in sorted(known.items())}
    try:
        return list(TopologicalSorter(graph).static_order())
    except CycleError as error:
        raise ValueError(f"models read each other in a circle: {error.args[1]}") from error


def run_graph(
    spark: SparkSession,
    models: Sequence[Model],
    relations: Mapping[tuple[str, str], str | DataFrame],
    database: str | None = None,
) -> GraphRun:
    """Build the models in order. Where one fails, what reads it is skipped and the others go on.

    A model is handed the relations it declares and no others, so the lineage is
    what it read. Its name is put into ``database`` when it is kept as a table.
    """
    known = {model.name: model for model in models}
    states: dict[str, str] = {}
    errors: dict[str, Exception] = {}
    built: dict[str, DataFrame] = {}
    for name in run_order(models):
        model = known[name]
        if any(states[parent] != BUILT for parent in model.parents):
            states[name] = SKIPPED
            continue
        try:
            declared = {(g, t): built[t] if g == MODELS else relations[(g, t)] for g, t in model.reads}
            kept = f"{database}.{name}" if database and model.options.get("materialized") != "view" else name
            built[name] = run_model(spark, kept, Sources(spark, declared), model.build, model.layer, **model.options)
            states[name] = BUILT
        except Exception as error:  # noqa: BLE001  whatever it is, the models beside it can be built
            states[name], errors[name] = FAILED, error
    return GraphRun(states, errors)


def lineage(spark: SparkSession, models: Sequence[Model]) -> DataFrame:
    """One row per model and relation that it depends on: model, source, steps.

    ``steps`` is the length of the shortest way, 1 for what it reads itself.
    """
    known = {model.name: model for model in models}
    rows = []
    for model in models:
        reached: dict[str, int] = {}
        edge, steps = list(model.reads), 1
        while edge:
            onward = []
            for group, table in edge:
                if reached.setdefault(f"{group}.{table}", steps) == steps and group == MODELS:
                    onward += known[table].reads
            edge, steps = onward, steps + 1
        rows += [(model.name, source, steps) for source, steps in reached.items()]
    return spark.createDataFrame(rows, "model string, source string, steps int")
