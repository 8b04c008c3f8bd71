"""The models, what they are built from, and building a selection of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from flowgauge.plans import marts, staging
from flowgauge.plans.changes import fingerprint, source_state, store_fingerprint, stored_fingerprint
from flowgauge.schemas import MODEL_COMMENTS, SlaThresholds, with_comments


@dataclass(frozen=True)
class Model:
    """A function over the frames named in ``inputs``."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    tags: frozenset[str]
    stored: bool = True  # a table; otherwise a view


MODELS: dict[str, Model] = {
    "stg_dag_runs": Model(
        staging.stg_dag_runs, ("dag_runs",), frozenset({"staging", "dag_runs"}), stored=False
    ),
    "stg_task_instances": Model(
        staging.stg_task_instances,
        ("task_instances",),
        frozenset({"staging", "task_instances"}),
        stored=False,
    ),
    "dag_runtime_metrics": Model(
        marts.dag_runtime_metrics, ("stg_dag_runs",), frozenset({"marts", "dag_metrics"})
    ),
    "dag_failure_rates": Model(
        marts.dag_failure_rates, ("stg_dag_runs",), frozenset({"marts", "dag_metrics"})
    ),
    "slowest_tasks": Model(
        marts.slowest_tasks, ("stg_task_instances",), frozenset({"marts", "task_metrics"})
    ),
    "sla_misses": Model(
        marts.sla_misses,
        ("stg_dag_runs", "stg_task_instances"),
        frozenset({"marts", "sla_metrics"}),
    ),
}


def _related(names: set[str], before: bool, after: bool) -> set[str]:
    """The models with all that they are built from, or with all that are built from them."""
    found = set(names)
    while True:
        above = {i for name in found for i in MODELS[name].inputs if i in MODELS} if before else set()
        below = {name for name, model in MODELS.items() if found.intersection(model.inputs)} if after else set()
        if above | below <= found:
            return found
        found |= above | below


def selected_models(select: Iterable[str] | None = None) -> list[str]:
    """Model names in build order: all, or those given as ``name`` or ``tag:name``.

    A plus in front adds all models that the given ones are built from, a plus at the end
    all that are built from them: ``+sla_misses``, ``tag:staging+``.  Without it, models
    that a selected one is built from are not selected with it.
    """
    order = list(
        TopologicalSorter(
            {name: [i for i in model.inputs if i in MODELS] for name, model in MODELS.items()}
        ).static_order()
    )
    if select is None:
        return order
    chosen: set[str] = set()
    unknown = set()
    for wanted in select:
        bare = wanted.removeprefix("+").removesuffix("+")
        named = {n for n, model in MODELS.items() if bare == n or bare in {f"tag:{tag}" for tag in model.tags}}
        if not named:
            unknown.add(wanted)
        # Up and down are followed apart: what else is built from a model above is not added.
        chosen |= _related(named, wanted.startswith("+"), False) | _related(named, False, wanted.endswith("+"))
    if unknown:
        raise ValueError(f"unknown models or tags: {', '.join(sorted(unknown))}")
    return [name for name in order if name in chosen]


def source_names(name: str) -> list[str]:
    """The sources that a model is built from, directly or through other models."""
    return sorted({i for n in _related({name}, True, False) for i in MODELS[n].inputs if i not in MODELS})


def model_frames(
    sources: Mapping[str, DataFrame],
    thresholds: SlaThresholds = SlaThresholds(),
    dedupe: bool = False,
) -> Callable[[str], DataFrame]:
    """A lookup of models by name over the given sources; no job runs yet."""
    frames = dict(sources)

    def frame(name: str) -> DataFrame:
        if name not in frames:
            model = MODELS[name]
            settings = {"thresholds": thresholds} if name == "sla_misses" else {}
            if name.startswith("stg_"):
                settings = {"dedupe": dedupe}
            built = model.build(*[frame(i) for i in model.inputs], **settings)
            frames[name] = with_comments(built, name)
        return frames[name]

    return frame


def build_models(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    select: Iterable[str] | None = None,
    database: str = "default",
    thresholds: SlaThresholds = SlaThresholds(),
    dedupe: bool = False,
    only_changed: bool = False,
) -> list[str]:
    """Build the selected models in order: staging as views, marts as full rebuilds of tables.

    ``dedupe`` keeps the newest copy of every run in the staging models, where load
    windows overlap.  With ``only_changed`` a table stays as it is if it was built by the same
    query, settings included, from the same files; views cost nothing and are always
    made.  Sources that are not a table or path of files always count as changed, and a table
    that something else writes to is not noticed.  Returns the models that were built.
    """
    frame = model_frames(sources, thresholds, dedupe)
    chosen = selected_models(select)
    needed = sorted({source for name in chosen if MODELS[name].stored for source in source_names(name)})
    # Read before anything is built: files that come in meanwhile make the next build, not none.
    states = {source: source_state(sources[source]) for source in needed} if only_changed else {}
    built = []
    for name in chosen:
        if MODELS[name].stored:
            table = f"{database}.{name}"
            mark = fingerprint(frame(name), [states[s] for s in source_names(name)]) if only_changed else None
            if mark and mark == stored_fingerprint(spark, table):
                continue
            # A new table has no property, so one that breaks off is built again.
            frame(name).write.mode("overwrite").saveAsTable(table)
            spark.sql(f"COMMENT ON TABLE {table} IS '{MODEL_COMMENTS[name][0]}'")
            if mark:
                store_fingerprint(spark, table, mark)
        else:
            frame(name).createOrReplaceTempView(name)
        built.append(name)
    return built


def stored_relations(
    spark: SparkSession, database: str = "default", names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """The raw tables and models as last built (all, or those named), e.g. for ``quality.run_model_tests``."""
    raw = ["dag_runs", "task_instances"]
    return {
        name: spark.table(f"{database}.{name}" if name in raw or MODELS[name].stored else name)
        for name in (names if names is not None else [*raw, *MODELS])
    }
