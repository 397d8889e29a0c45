"""Runs models in order of their references and writes them; a model that a marker names as done isn't built again."""

from __future__ import annotations

from papyrine.plans.models import MODELS, TAGS, Context
from papyrine.session import read_table
from papyrine.sources.sinks import is_done, mark_done, refresh


def select(what: str | list[str] | None = None) -> list[str]:
    """Names of models by tag (data_ingestion, data_enrichment), layer or name; None is all. Those they refer to come first."""
    wanted = [what] if isinstance(what, str) else list(what or MODELS)
    chosen = [n for n, m in MODELS.items() if n in wanted or m.layer in wanted or any(w in TAGS and m.layer in TAGS[w] for w in wanted)]
    order: list[str] = []

    def visit(name: str) -> None:
        for ref in MODELS[name].refs:
            visit(ref)
        if name not in order:
            order.append(name)

    for name in chosen:
        visit(name)
    return order


def run(ctx: Context, warehouse: str, what: str | list[str] | None = None, run_id: str | None = None) -> list[str]:
    """Builds the selected models as Parquet tables of the warehouse folder and returns the names of those built now. With a
    run id each leaves a marker, so a run that was interrupted goes on where it stopped."""
    built = []
    for name in select(what):
        marker = f"{warehouse}/_done/{run_id}/{name}.json"
        if run_id is None or not is_done(ctx.spark, marker):
            refresh(MODELS[name].build(ctx), f"{warehouse}/{name}.parquet")
            if run_id is not None:
                mark_done(ctx.spark, marker, model=name, run=run_id)
            built.append(name)
        ctx.built[name] = read_table(ctx.spark, warehouse, name)
    return built
