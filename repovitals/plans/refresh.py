"""The refresh of all layers: stage and hubs, then enrich, then curate."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.operators.enrich import enrich
from repovitals.operators.hubs import hub_commits, hub_contributors, hub_issues, hub_releases
from repovitals.operators.metrics import risk_counts, run_metrics
from repovitals.operators.risk import risk_product
from repovitals.operators.stage import stage_repositories
from repovitals.sources.store import LayerStore

#: Jobs that read a raw table only: target table, raw table, job.
FROM_RAW: tuple[tuple[str, str, Callable[..., DataFrame]], ...] = (
    ("stg_repositories", "raw_repositories", stage_repositories),
    ("hub_contributors", "raw_contributors", hub_contributors),
    ("hub_commits", "raw_commits", hub_commits),
    ("hub_issues", "raw_issues", hub_issues),
    ("hub_releases", "raw_releases", hub_releases),
)


def enrich_stored(store: LayerStore, as_of: Column, source: str = fx.SOURCE) -> DataFrame:
    """`enrich` over the stored stage and hub tables."""
    keys = ("stg_repositories", "hub_contributors", "hub_commits", "hub_issues", "hub_releases")
    return enrich(*map(store.read, keys), as_of, source)


def refresh(
    store: LayerStore, as_of: Column, source: str = fx.SOURCE, mode: str = "snapshot"
) -> DataFrame:
    """Rebuild every layer of one source from its raw tables; returns the counters of this run.

    Each layer is written and read back: a lost executor then costs the running job only, and the
    status report needs the tables anyway. The five jobs that depend on raw tables alone run side
    by side, so their tasks fill the cluster together.

    `snapshot` replaces the source's rows and can be run again with the same outcome. `append` adds
    a copy per run, after which enrich joins every copy with every copy.
    """
    if mode not in ("snapshot", "append"):
        raise ValueError(f"unknown mode: {mode!r}")

    written: dict[str, dict[str, int]] = {}

    def write(key: str, frame: DataFrame) -> None:
        counts = Observation()
        frame = frame.observe(counts, F.count(F.lit(1)).alias("rows"), *(risk_counts() if key == "risk_product" else ()))
        if mode == "snapshot":
            store.replace(key, frame, source)
        else:
            store.append(key, frame)
        written[key] = counts.get

    def from_raw(step: tuple[str, str, Callable[..., DataFrame]]) -> None:
        target, raw, job = step
        write(target, job(store.read(raw), as_of, source))

    with ThreadPoolExecutor(len(FROM_RAW)) as pool:
        for done in [pool.submit(from_raw, step) for step in FROM_RAW]:
            done.result()
    write("repo_entryline", enrich_stored(store, as_of, source))
    write("risk_product", risk_product(store.read("repo_entryline"), as_of, source))
    return run_metrics(store.read("raw_repositories"), written, source)
