"""Entry points for checking: the flagship query, all queries, and the SQL each must agree with.

The queries work on raw tables that Spark derives from the given tables. The raw tables are written
once per session and data folder, as a landing job would, and the layers above them likewise: every
job then reads stored tables, as it does in production.
"""

from __future__ import annotations

import sys
import tempfile
import uuid
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import repovitals as rv  # noqa: E402
from checks.oracle import SQL  # noqa: E402
from repovitals import fixed_values as fx  # noqa: E402
from repovitals.functions.times import ntz  # noqa: E402
from repovitals.operators.quality import exact_quantiles  # noqa: E402
from repovitals.plans import monitoring  # noqa: E402
from repovitals.plans.refresh import enrich_stored  # noqa: E402
from repovitals.schemas import RAW_TABLES, TABLES, conform  # noqa: E402
from repovitals.sources import star_schema  # noqa: E402
from repovitals.sources.landing import fit_columns  # noqa: E402
from repovitals.sources.store import shared_folder  # noqa: E402

LLM_QUERIES: dict = {}
LLM_SQL: dict = {}
try:  # the only guard: the subpackage and the pipeline built on it may be absent
    from repovitals.llm.queries import QUERIES as LLM_QUERIES
    from repovitals.llm.queries import SQL as LLM_SQL

    import corpus_pipeline

    LLM_QUERIES = {"pipeline": corpus_pipeline.run, **LLM_QUERIES}
    if corpus_pipeline.ORACLE_SQL:
        LLM_SQL = {"pipeline": corpus_pipeline.ORACLE_SQL, **LLM_SQL}
except ModuleNotFoundError as missing:
    removed = missing.name in ("repovitals.llm", "repovitals.llm.queries", "corpus_pipeline")
    if not removed and missing.name.split(".")[0] in ("repovitals", "checks", "pyspark"):
        raise
    if not removed:  # a package that only these operators need
        warnings.warn(f"queries on training text are left out: there is no module {missing.name}", stacklevel=1)

FLAGSHIP_DATA = "/root/testdata/sf0.001"
AS_OF = "2001-11-05 00:00:00"
EVENTS_AS_OF = "2024-02-10 00:00:00"

_landed: dict[tuple[str, str], rv.LayerStore] = {}
_refreshed: dict[tuple[str, str], rv.LayerStore] = {}
_loaded_twice: dict[tuple[str, str], rv.StatusStates] = {}


def as_of():
    return ntz(AS_OF)


def session_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; set here for a session on this machine that lacks it."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="repovitals-"))
    return shared_folder(spark)


def land_raw(spark: SparkSession, sf_dir: str) -> rv.LayerStore:
    """A new store holding the raw tables."""
    store = rv.LayerStore(spark, session_folder(spark))

    def land(key: str) -> None:
        derived = star_schema.RAW_DERIVATIONS[key](spark, sf_dir)
        rv.write_raw(store, key, derived, as_of(), "truncate")

    with ThreadPoolExecutor(len(RAW_TABLES)) as pool:
        for done in [pool.submit(land, key) for key in RAW_TABLES]:
            done.result()
    return store


def raw_store(spark: SparkSession, sf_dir: str) -> rv.LayerStore:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        _landed[key] = land_raw(spark, sf_dir)
    return _landed[key]


def full_store(spark: SparkSession, sf_dir: str) -> rv.LayerStore:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _refreshed:
        store = raw_store(spark, sf_dir)
        rv.refresh(store, as_of())
        _refreshed[key] = store
    return _refreshed[key]


Query = Callable[[SparkSession, str], DataFrame]


def _on_raw(table: str, job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(raw_store(spark, sf_dir).read(table))


def _on_layer(table: str, job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(full_store(spark, sf_dir).read(table))


def _on_store(job: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(full_store(spark, sf_dir).read_layers())


def _on_events(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(star_schema.event_lines(spark, sf_dir))


def _on_pages(job: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(star_schema.search_pages(spark, sf_dir))


def _end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything from the given tables on, in a store of its own."""
    store = land_raw(spark, sf_dir)
    rv.refresh(store, as_of())
    return store.read("risk_product")


def _streaming_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product of a refresh that the arrival of raw files set off."""
    store = land_raw(spark, sf_dir)
    rv.refresh_if_new(store, f"{store.root}/checkpoint", AS_OF)
    return store.read("risk_product")


def _event_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the events as gzip JSON lines, each 97th line damaged, and read them back."""
    folder = session_folder(spark)
    line = F.to_json(F.struct("type", "created_at", "repo", "actor"))
    damaged = F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))
    lines = star_schema.event_lines(spark, sf_dir, keep=("event_id",)).select(
        F.when(F.col("event_id") % 97 == 0, damaged).otherwise(line).alias("value")
    )
    lines.write.option("compression", "gzip").text(folder)
    return rv.repos_from_events(rv.read_event_log(spark, folder), as_of())


def _events_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event hours taken one arrival after the other: later ones first, some of them again, then folded."""
    store = rv.LayerStore(spark, session_folder(spark))
    lines = star_schema.event_lines(spark, sf_dir, keep=("event_id",)).select(
        F.to_json(F.struct("type", "created_at", "repo", "actor")).alias("value"), (F.col("event_id") % 24).alias("hour")
    )
    landed, hours = f"{store.root}/landed", rv.EventHours(store)

    def land(name: str, rows: DataFrame) -> None:
        rows.write.option("compression", "gzip").partitionBy("hour").text(f"{landed}/{name}")

    land("first", lines.filter("hour >= 12"))
    hours.absorb(f"{landed}/*/*")
    land("second", lines.filter("hour < 12"))
    path = spark._jvm.org.apache.hadoop.fs.Path
    files, conf = path(landed).getFileSystem(spark._jsc.hadoopConfiguration()), spark._jsc.hadoopConfiguration()
    for hour in (13, 14, 20):
        copy = spark._jvm.org.apache.hadoop.fs.FileUtil.copy
        copy(files, path(f"{landed}/first/hour={hour}"), files, path(f"{landed}/again/hour={hour}"), False, conf)
    hours.absorb(f"{landed}/*/*")
    hours.fold()
    hours.absorb(f"{landed}/*/*")
    return hours.repositories(as_of())


def _delta_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product after a second arrival with updates, repositories that become invalid, and more hub rows."""
    raw = raw_store(spark, sf_dir)
    store = rv.LayerStore(spark, session_folder(spark))
    layers = rv.DeltaLayers(store, buckets=16)  # a bucket should be worth a file; the default is for large tables
    part = star_schema.table(spark, sf_dir, "part")
    name = F.concat("p_brand", F.lit("/repo-"), F.col("p_partkey").cast("string"))
    invalid = part.filter("p_partkey % 29 = 5").select(
        F.lit(fx.SOURCE).alias("data_source"), F.lit("").alias("id"), F.lit("gone").alias("name"), name.alias("full_name"),
        F.col("p_brand").alias("owner"), F.lit(1).alias("stars"), F.lit(1).alias("forks"),
        ntz("2001-06-01 00:00:00").alias("updated_at"),
    )
    more = part.filter("p_partkey % 31 = 7").select(
        F.lit(fx.SOURCE).alias("data_source"), name.alias("repo"),
        *(F.lit(n).alias(f"commits_{days}d") for n, days in ((1, 30), (2, 90), (3, 180))),
    )
    extra = {"raw_repositories": invalid, "raw_commits": more}
    for second in (False, True):
        for key in RAW_TABLES:
            named = "repo_full_name" if key == "raw_contributors" else "full_name" if key == "raw_repositories" else "repo"
            late = F.coalesce(F.col(named), F.lit("")).rlike("7 *$")
            if key == "raw_repositories":
                late = late | F.col("id").endswith("_dup")
            rows = raw.read(key)
            rv.write_raw(store, key, rows.filter(late) if second else rows.filter(~late), as_of())
            if second and key in extra:
                rv.write_raw(store, key, extra[key], as_of())
        rv.refresh_changed(layers, AS_OF)
    return layers.read("risk_product")


def _stage_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged table after two loads, of which the second brings rows of names that the first had too."""
    raw = raw_store(spark, sf_dir).read("raw_repositories")
    layers = rv.DeltaLayers(rv.LayerStore(spark, session_folder(spark)), buckets=16)
    late = F.col("id").endswith("_dup") | F.coalesce(F.col("stars") % 4 == 1, F.lit(True))
    for load, rows in enumerate((raw.filter(~late), raw)):
        layers.upsert_stage(rv.cleanse_repositories(rows, as_of()), load)
    return layers.read("stg_repositories")


def status_states(spark: SparkSession, sf_dir: str) -> rv.StatusStates:
    """States of a store after two loads: the second appends, replaces one raw source and refreshes all layers again."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded_twice:
        raw = raw_store(spark, sf_dir)
        store = rv.LayerStore(spark, session_folder(spark))
        states = rv.StatusStates(store)
        other = F.coalesce(F.col("data_source") != fx.SOURCE, F.lit(False))
        for load in (0, 1):
            for table in RAW_TABLES:
                rows = raw.read(table)
                dealt = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == load
                rv.write_raw(store, table, rows.filter(~other & dealt), as_of())
                rv.write_raw(store, table, rows.filter(other & dealt) if load == 0 else rows.filter(other), as_of(), "overwrite")
            states.absorb(RAW_TABLES)
            rv.refresh(store, as_of())
            states.absorb([table for table in monitoring.REPORTED if table not in RAW_TABLES])
        _loaded_twice[key] = states
    return _loaded_twice[key]


def _search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of terms, some of them wildcards only, against an index that took the names in two additions."""
    product = full_store(spark, sf_dir).read("risk_product")
    index = rv.NameSearch(rv.LayerStore(spark, session_folder(spark)), buckets=16)
    index.add(product.filter(F.col("stars") % 3 == 0))
    index.add(product)
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    terms = part.select(
        F.explode(
            F.array(
                "p_brand",
                F.lower(F.replace("p_brand", F.lit("#"), F.lit("_"))),
                F.right("p_brand", F.lit(2)),
                F.concat(F.lit("-"), (F.col("p_partkey") % 200).cast("string")),
                F.expr("repeat('_', cast(p_partkey % 3 as int))"),
            )
        ).alias("term")
    )
    return index.search(product, terms)


def _search_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages that land in three arrivals, later pages first, taken after each."""
    store = rv.LayerStore(spark, session_folder(spark))
    pages, landed = rv.SearchPages(store, packed=True), f"{store.root}/landed"
    found = star_schema.search_pages(spark, sf_dir)
    for rest in (2, 0, 1):
        _page_lines(found.filter(F.col("page") % 3 == rest)).write.mode("append").text(landed)
        pages.absorb(landed)
    return pages.repositories()


def _page_lines(pages: DataFrame) -> DataFrame:
    """Search pages as landed in packed files: a line each, with the page's name."""
    name = F.concat(F.lit("page_"), F.col("page").cast("string")).alias("page")
    return pages.select(F.to_json(F.struct(name, "items")).alias("value"))


def _enrich_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrich over bucketed tables, written first."""
    store, prefix = full_store(spark, sf_dir), f"colocated_{uuid.uuid4().hex}"
    keys = ("stg_repositories", "hub_contributors", "hub_commits", "hub_issues", "hub_releases")
    rv.write_colocated(*map(store.read, keys), prefix, session_folder(spark), buckets=16)
    return rv.enrich_colocated(spark, prefix, as_of())


def _export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session_folder(spark)
    rv.export_csv(full_store(spark, sf_dir).read("risk_product"), folder)
    return spark.read.schema(TABLES["risk_product"].schema).option("header", True).csv(folder)


def _raw_from_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories from events and search pages, landed in a raw table and read back."""
    store = rv.LayerStore(spark, session_folder(spark))
    events = rv.repos_from_events(star_schema.event_lines(spark, sf_dir), as_of())
    found = rv.repos_from_search(star_schema.search_pages(spark, sf_dir))
    rv.write_raw(store, "raw_repositories", rv.to_raw_repositories(events), as_of(), "truncate")
    rv.write_raw(store, "raw_repositories", rv.to_raw_repositories(found), as_of(), "append")
    return store.read("raw_repositories")


def _union_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("id", "full_name", "name", "owner", "html_url", "updated_at")
    events = rv.repos_from_events(star_schema.event_lines(spark, sf_dir), as_of())
    found = rv.repos_from_search(star_schema.search_pages(spark, sf_dir))
    return rv.union_by_priority([events.select(*columns), found.select(*columns)])


def _search_page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the search pages as JSON documents, many a file, and read them back in the pages' order."""
    folder = session_folder(spark)
    _page_lines(star_schema.search_pages(spark, sf_dir)).write.text(folder)
    return rv.repos_from_search(rv.read_search_pages(spark, folder, packed=True))


def _enrich_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hubs with up to four rows a repository, the last name (by text) with forty times as many."""
    store = full_store(spark, sf_dir)
    stage = store.read("stg_repositories")
    last = stage.filter("valid_flag").agg(F.max("full_name")).scalar()

    def several(key: str, up_to: int) -> DataFrame:
        rows = store.read(key)
        copies = (F.length("repo") % up_to + 1) * F.when(F.col("repo") == last, 40).otherwise(1)
        return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).drop("copy")

    hubs = [several("hub_commits", 2), several("hub_issues", 3), several("hub_releases", 4)]
    return rv.enrich(stage, store.read("hub_contributors"), *hubs, as_of()).groupBy("full_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.sum(c).alias(f"sum_{c}") for c in ("commits_90d", "open_issues", "release_count", "total_contributors")),
    )


def _load_metrics_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the second of two appending refreshes."""
    store = land_raw(spark, sf_dir)
    rv.refresh(store, as_of(), mode="append")
    return rv.refresh(store, as_of(), mode="append")


def _truncate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as input: their text is wider than every column it goes to."""
    documents = star_schema.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("name"),
        F.col("text").alias("full_name"),
        F.col("source").alias("owner"),
        F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("language"),
        F.col("text").alias("html_url"),
    )
    return fit_columns(documents, TABLES["raw_repositories"].widths)


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log in which each order is a run, open, finished or failed."""

    # Four streams number their batches alike.
    batch = F.expr("o_orderkey div 4")
    stream = F.concat(F.lit("stream-"), (F.col("o_orderkey") % 4).cast("string"))

    def entry(stage: str, status: str, message, ts, run_id=batch):
        return F.struct(
            stream.alias("stream"),
            run_id.alias("run_id"),
            F.lit(fx.SOURCE).alias("source"),
            F.lit(fx.PIPELINE).alias("pipeline_name"),
            F.lit(stage).alias("stage"),
            F.lit(status).alias("status"),
            message.alias("message"),
            ts.alias("ts"),
        )

    begin = F.col("o_orderdate")
    end = begin + F.make_dt_interval(mins=(F.col("o_custkey") % 10).cast("int"))
    failed = F.concat(F.lit(fx.MESSAGE_ERROR_PREFIX), F.col("o_orderpriority"))
    nobody = F.lit(None).cast("bigint")
    entries = F.array(
        entry(fx.STAGE_RUN, fx.STATUS_STARTED, F.lit(fx.MESSAGE_STARTED), begin),
        F.when(
            F.col("o_orderstatus") == "F",
            entry(fx.STAGE_RUN, fx.STATUS_COMPLETED, F.lit(fx.MESSAGE_COMPLETED), end),
        ).when(F.col("o_orderstatus") == "P", entry(fx.STAGE_RUN, fx.STATUS_ERROR, failed, end)),
        F.when(
            F.col("o_custkey") % 7 == 0,
            entry(fx.STAGE_CHECK, fx.STATUS_SKIPPED, F.lit(fx.MESSAGE_SKIPPED), end, nobody),
        ),
    )
    orders = star_schema.table(spark, sf_dir, "orders")
    return rv.run_log_latest(orders.select(F.inline(F.array_compact(entries))))


def _event_type_sets(events: DataFrame) -> DataFrame:
    return rv.event_type_maps(events).select(
        "full_name",
        F.array_join("event_types", ",").alias("event_types"),
        F.coalesce(F.col("event_counts")[fx.PUSH_EVENT], F.lit(0)).alias("pushes"),
        F.size("event_types").cast("bigint").alias("n_types"),
    )


def _last_name(product: DataFrame) -> DataFrame:
    """Which names there are depends on the data, so the last of them is asked for."""
    return rv.report_repo(product, F.lower(product.agg(F.max("full_name")).scalar()))


def _profile(enriched: DataFrame) -> DataFrame:
    """The profile counts missing languages as NULL, which the stage has named 'Unknown'."""
    language = F.nullif(F.col("language"), F.lit(fx.NO_LANGUAGE))
    return rv.profile_repositories(enriched.withColumn("language", language))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: risk by language, from the raw tables of the smallest data set on."""
    return rv.report_by_language(full_store(spark, FLAGSHIP_DATA).read("risk_product"))


def queries() -> dict[str, Query]:
    """One entry per job and operator."""
    return {
        **{key: _on_raw(key, lambda raw: raw) for key in RAW_TABLES},
        "stage_repositories": _on_raw("raw_repositories", lambda t: rv.stage_repositories(t, as_of())),
        "hub_contributors": _on_raw("raw_contributors", lambda t: rv.hub_contributors(t, as_of())),
        "hub_commits": _on_raw("raw_commits", lambda t: rv.hub_commits(t, as_of())),
        "hub_issues": _on_raw("raw_issues", lambda t: rv.hub_issues(t, as_of())),
        "hub_releases": _on_raw("raw_releases", lambda t: rv.hub_releases(t, as_of())),
        "contributors_agg": _on_layer("hub_contributors", rv.contributors_agg),
        "enrich_entryline": lambda spark, sf_dir: enrich_stored(full_store(spark, sf_dir), as_of()),
        "enrich_fanout": _enrich_fanout,
        "enrich_bucketed": _enrich_bucketed,
        "delta_refresh": _delta_refresh,
        "events_incremental": _events_incremental,
        "stage_upsert": _stage_upsert,
        "search_stream": _search_stream,
        "search_indexed": _search_indexed,
        "risk_factors": _on_layer("repo_entryline", rv.risk_factors),
        "risk_product": _on_layer("repo_entryline", lambda t: rv.risk_product(t, as_of())),
        "pipeline_end_to_end": _end_to_end,
        "streaming_refresh": _streaming_refresh,
        "load_metrics": _on_store(rv.load_metrics),
        "load_metrics_append": _load_metrics_append,
        "status_table_stats": _on_store(monitoring.status_table_stats),
        "status_stats_incremental": lambda spark, sf_dir: status_states(spark, sf_dir).table_stats(),
        "status_incremental": lambda spark, sf_dir: status_states(spark, sf_dir).pipeline_status(),
        "status_data_flow": _on_store(monitoring.status_data_flow),
        "status_last_loads": _on_store(monitoring.status_last_loads),
        "status_quality": _on_store(monitoring.status_quality),
        "status_risk": _on_store(monitoring.status_risk),
        "pipeline_status": _on_store(rv.pipeline_status),
        "pipeline_status_section": _on_store(lambda t: rv.status_section(t, fx.SECTION_QUALITY)),
        "report_summary": _on_layer("risk_product", rv.report_summary),
        "report_top_risky": _on_layer("risk_product", rv.report_top),
        "report_healthiest": _on_layer("risk_product", lambda t: rv.report_top(t, risky=False)),
        "report_top_display": _on_layer("risk_product", lambda t: rv.report_top_display(t, 20)),
        "report_by_language": _on_layer("risk_product", rv.report_by_language),
        "report_search": _on_layer("risk_product", lambda t: rv.report_search(t, "brand_1")),
        "report_repo": _on_layer("risk_product", _last_name),
        "report_export": _on_layer("risk_product", rv.report_export),
        "export_round_trip": _export_round_trip,
        "dataset_profile": _on_layer("repo_entryline", _profile),
        "dq_findings": _on_raw("raw_repositories", rv.dq_findings),
        "star_quantiles": _on_raw(
            "raw_repositories", lambda t: exact_quantiles(t, "stars", [0.01, 0.25, 0.5, 0.75])
        ),
        "events_to_repos": _on_events(lambda lines: rv.repos_from_events(lines, as_of())),
        "event_log_scan": _event_log_scan,
        "events_to_contributors": _on_events(lambda lines: rv.contributors_from_events(lines, ntz(EVENTS_AS_OF))),
        "events_to_commits": _on_events(lambda lines: rv.commits_from_events(lines, ntz(EVENTS_AS_OF))),
        "events_to_issues": _on_events(lambda lines: rv.issues_from_events(lines, ntz(EVENTS_AS_OF))),
        "event_type_counts": _on_events(rv.event_type_counts),
        "event_type_sets": _on_events(_event_type_sets),
        "search_to_repos": _on_pages(rv.repos_from_search),
        "search_to_issues": _on_pages(rv.issues_from_search),
        "search_page_scan": _search_page_scan,
        "days_since": _on_pages(lambda pages: rv.push_ages(pages, ntz("2001-09-01 12:00:00"))),
        "capped_union": _union_by_priority,
        "raw_from_sources": _raw_from_sources,
        "truncate_columns": _truncate_columns,
        "conform_schema": _on_raw(
            "raw_releases",
            lambda t: conform(
                t.drop("days_since_last_release", "load_timestamp")
                .withColumn("release_count", F.col("release_count").cast("string")),
                TABLES["raw_releases"],
                as_of(),
            ),
        ),
        "run_log_latest": _run_log,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """The SQL that must give the same rows, for every query."""
    return {**SQL, **LLM_SQL}
