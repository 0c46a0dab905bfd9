"""Run the jobs on large skewed tables and show how evenly their tasks are loaded.

    python checks/scale.py [data folder] [copies] [cores]

The raw tables are made from `lineitem`, each line taken `copies` times. A third of all rows belongs
to one repository (contributors, commits), to the nameless one (repositories, issues, releases) or,
of the events, to one repository. Broadcast joins by size are off, so that the joins shuffle as they
would with tables a thousand times larger. For every job the time is shown, and the share of rows
that its most loaded shuffle-reading task had.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import repovitals as rv  # noqa: E402
from repovitals.functions.times import ntz  # noqa: E402
from repovitals.plans import monitoring  # noqa: E402
from repovitals.plans.refresh import FROM_RAW  # noqa: E402
from repovitals.sources.star_schema import table  # noqa: E402

AS_OF = "2001-11-05 00:00:00"


def skewed_tables(spark: SparkSession, folder: str, copies: int, cores: int) -> dict[str, DataFrame]:
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line")
    lines = table(spark, folder, "lineitem").select(line, "l_suppkey", "l_quantity")
    # `key` numbers the rows; every third is hot.
    rows = lines.repartition(cores * 4).select("*", copy).select(
        "*", (F.col("line") * copies + F.col("copy")).alias("key")
    )
    hot, count = F.col("key") % 3 == 0, F.col("l_quantity").cast("bigint")
    own = F.concat(F.lit("org/repo-"), F.col("key").cast("string"))
    nameless, crowded = F.when(~hot, own), F.when(hot, "org/repo-1").otherwise(own)
    source = F.lit("git_hub").alias("data_source")
    year_2000 = ntz("2000-01-01 00:00:00")
    return {
        "raw_repositories": rows.select(
            source, F.col("key").cast("string").alias("id"), F.lit("n").alias("name"),
            nameless.alias("full_name"), F.concat(F.lit("o"), "l_suppkey").alias("owner"),
            F.lit("Go").alias("language"), (F.col("key") % 20000).alias("stars"), count.alias("forks"),
            F.lit("u").alias("html_url"), year_2000.alias("created_at"), year_2000.alias("updated_at"),
        ),
        "raw_contributors": rows.select(
            source, crowded.alias("repo_full_name"),
            F.concat(F.lit("c"), F.col("key") % 1_000_000).alias("contributor"),
            count.alias("total_commits"), (F.col("key") % 3).alias("recent_90_days_commits"),
        ),
        "raw_commits": rows.select(source, crowded.alias("repo"), count.alias("commits_90d")),
        "raw_issues": rows.select(source, nameless.alias("repo"), count.alias("open_issues")),
        "raw_releases": rows.select(source, nameless.alias("repo"), count.alias("release_count")),
        "events": rows.select(
            F.lit("PushEvent").alias("type"), F.lit("2020-01-01T00:00:00Z").alias("created_at"),
            F.struct(F.when(hot, "org/repo-1").otherwise(own).alias("name")).alias("repo"),
            F.struct(F.concat(F.lit("u"), F.col("key") % 5_000_000).alias("login")).alias("actor"),
        ),
    }


def loads(event_log: str) -> list[tuple[int, int, int, int]]:
    """Of each stage: start time, its tasks, rows read from shuffles by all and by the busiest task."""
    stages: dict[int, list[tuple[int, int]]] = {}
    for file in Path(event_log).iterdir():
        for text in file.read_text().splitlines():
            event = json.loads(text)
            if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                stages.setdefault(event["Stage ID"], []).append((event["Task Info"]["Launch Time"], read))
    return [
        (min(begin for begin, _ in tasks), len(tasks), sum(n for _, n in tasks), max(n for _, n in tasks))
        for tasks in stages.values()
    ]


def main(arguments: list[str]) -> None:
    folder = arguments[0] if arguments else "/root/testdata/sf0.1"
    copies = int(arguments[1]) if len(arguments) > 1 else 5
    cores = int(arguments[2]) if len(arguments) > 2 else 8
    event_log, root = tempfile.mkdtemp(prefix="scale-log-"), tempfile.mkdtemp(prefix="scale-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", event_log)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    store, as_of = rv.LayerStore(spark, root), ntz(AS_OF)
    tables = skewed_tables(spark, folder, copies, cores)
    for _, key, _ in FROM_RAW:
        rv.write_raw(store, key, tables[key], as_of, "truncate")
    total = store.read("raw_repositories").count()

    times: list[tuple[str, float, float]] = []

    def timed(name: str, work: Callable[[], object]) -> None:
        begin = time.time()
        work()
        times.append((name, begin, time.time()))
        print(f"{name:24s} {times[-1][2] - begin:7.1f} s", flush=True)

    def run(name: str, frame: Callable[[], DataFrame]) -> None:
        timed(name, lambda: frame().write.format("noop").mode("overwrite").save())

    for target, raw, job in FROM_RAW:
        timed(target, lambda t=target, r=raw, j=job: store.replace(t, j(store.read(r), as_of), "git_hub"))
    hubs = [store.read(key) for key in ("hub_commits", "hub_issues", "hub_releases")]
    stage, people = store.read("stg_repositories"), store.read("hub_contributors")
    timed("enrich", lambda: store.replace("repo_entryline", rv.enrich(stage, people, *hubs, as_of), "git_hub"))
    enriched = store.read("repo_entryline")
    timed("risk_product", lambda: store.replace("risk_product", rv.risk_product(enriched, as_of), "git_hub"))
    product, layers = store.read("risk_product"), store.read_layers()
    run("load_metrics", lambda: rv.load_metrics(layers))
    run("pipeline_status", lambda: rv.pipeline_status(layers))
    run("status_table_stats", lambda: monitoring.status_table_stats(layers))
    run("dq_findings", lambda: rv.dq_findings(store.read("raw_repositories")))
    run("report_by_language", lambda: rv.report_by_language(product))
    run("report_top", lambda: rv.report_top(product))
    run("report_export", lambda: rv.report_export(product))
    run("repos_from_events", lambda: rv.repos_from_events(tables["events"], as_of))
    run("event_type_counts", lambda: rv.event_type_counts(tables["events"]))
    spark.stop()

    print(f"\n{total} rows per table, a third of them in one group, {cores} cores")
    print("job                       seconds   rows/s   busiest task's share of its stage's rows")
    stages = loads(event_log)
    for name, begin, end in times:
        # Only stages that read many rows tell something about the spread of the rows.
        shares = [
            most / rows
            for start, tasks, rows, most in stages
            if begin * 1000 <= start <= end * 1000 and tasks > 1 and rows > total / 2
        ]
        spread = f"{max(shares):6.1%}" if shares else "no large shuffle"
        print(f"{name:24s} {end - begin:8.1f} {total / (end - begin):8.0f}   {spread}")


if __name__ == "__main__":
    main(sys.argv[1:])
