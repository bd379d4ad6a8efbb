"""Command line: set up tables, load history, deploy a match, run the streams, publish them."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import baseline, normalise
from touchline.operators.sessions import team_options
from touchline.session import build_session
from touchline.sources import control, csvfiles, files, messages, tables
from touchline.streaming import jobs

LOAD = "_load"
DIMENSION_FILES = {
    "players": "players.csv",
    "teams": "teams.csv",
    "matches": "matches_*.csv",
    "event_names": "eventid2name.csv",
    "tags": "tags2name.csv",
    "competitions": "competitions.csv",
}


def set_up(spark: SparkSession, options: argparse.Namespace) -> None:
    tables.create_warehouse(spark, options.database, options.location)
    tables.create_dictionaries(spark, options.database, options.location)
    tables.create_serving(spark, options.database, options.location)


def load(spark: SparkSession, options: argparse.Namespace) -> None:
    """Facts are appended. Dimensions are merged by key with what was loaded before, the
    newest row of a key winning, and published as a new version; one without CSV files
    stays as it is. Events per match are stored for each load, and the mean over all loads: live
    views needn't read facts, and a load reads none but its own. With ``--database`` the tables
    that ``setup`` has made hold the facts and the newest dimensions."""
    published = jobs.ServingFrames(options.warehouse)
    for name, pattern in DIMENSION_FILES.items():
        table = (schemas.WAREHOUSE | schemas.DICTIONARIES)[name]
        if not files.glob(spark, f"{options.csv}/{pattern}"):
            print(f"no {pattern}: {name} left as they are")
            continue
        rows = csvfiles.load_dimension(spark, f"{options.csv}/{pattern}", table)
        before = published.read(spark, name, table.schema).withColumn(LOAD, F.lit(0))
        both = before.unionByName(rows.withColumn(LOAD, F.lit(1)))
        merged = normalise.dedupe(both, table.key, LOAD).select(*table.columns)
        published.publish(name, tables.laid_out(merged, table))
        if options.database:
            newest = published.read(spark, name, table.schema)
            tables.replace(newest, f"{options.database}.{name}")
    facts = csvfiles.load_facts(spark, f"{options.csv}/events_*.csv")
    target = f"{options.warehouse}/{schemas.FACTS.name}"
    if options.database:
        target = f"{options.database}.{schemas.FACTS.name}"
    report = tables.append(facts, target, schemas.FACTS, layout="ranged")
    counted = f"{options.warehouse}/events_per_match"
    if not files.exists(spark, counted):
        # What other loads have stored before counts too.
        reader = spark.read.schema(schemas.FACTS.schema)
        facts = spark.table(target) if options.database else reader.parquet(target)
    new = baseline.events_per_match(facts)
    new.write.mode("append").parquet(counted)
    published.publish("average", baseline.average_of(spark.read.schema(new.schema).parquet(counted)))
    print(f"appended {report.rows} events to {report.target}")


def publish(spark: SparkSession, options: argparse.Namespace) -> None:
    """The live tables as they are now, into the serving tables that ``setup`` has made."""
    live = jobs.read_live_events(
        spark,
        f"{options.root}/live_events",
        buckets=options.buckets,
        resets=control.read_resets(spark, f"{options.root}/resets"),
    )
    tables.replace(live, f"{options.database}.live_events")
    tables.replace(jobs.team_stats(options.root).read(spark), f"{options.database}.live_team_stats")


def deploy(spark: SparkSession, options: argparse.Namespace) -> None:
    teams = jobs.ServingFrames(options.warehouse).read(spark, "teams", schemas.TEAMS.schema)
    live_tables = (jobs.team_stats(options.root),) if options.truncate else ()
    session = control.deploy_match(
        spark,
        team_options(teams),
        options.home,
        options.away,
        f"{options.root}/control",
        live_tables,
    )
    print(f"deployed session {session}")


def reset(spark: SparkSession, options: argparse.Namespace) -> None:
    counts = jobs.team_stats(options.root)
    control.reset_session(spark, f"{options.root}/resets", options.session, counts)


def stream(spark: SparkSession, options: argparse.Namespace) -> None:
    how = {"ordered": not options.unordered} if options.source == "files" else {}
    source = messages.message_stream(spark, options.source, options.messages, **how)
    trigger = jobs.Trigger(options.every)
    queries = jobs.start_all(
        source,
        options.root,
        trigger,
        options.version,
        options.buckets,
        options.state_partitions,
    )
    if not options.every:
        for query in queries:
            query.awaitTermination()
        queries = []
    if options.names:
        events = messages.valid_events(messages.decode(source))
        queries.append(
            jobs.start_enriched(
                events,
                jobs.published_dimensions(spark, options.warehouse),
                jobs.enriched_log(f"{options.root}/named_events"),
                f"{options.root}/checkpoints/{options.version}/named",
                trigger,
                options.version,
            )
        )
    if options.views:
        queries.append(
            jobs.start_views(
                spark, options.root, options.warehouse, trigger, options.version, options.buckets
            )
        )
    if options.every:
        jobs.await_any(spark)
    for query in queries:
        query.awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="touchline", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    command = commands.add_parser("setup", help="create the tables")
    command.add_argument("--database", default="analytics")
    command.add_argument("--location")
    command.set_defaults(run=set_up)

    command = commands.add_parser("load", help="load the CSV history")
    command.add_argument("--csv", required=True, help="folder of the CSV files")
    command.add_argument("--warehouse", required=True, help="folder of the Parquet tables")
    command.add_argument("--database", help="load into the tables of this database")
    command.set_defaults(run=load)

    command = commands.add_parser("publish", help="write the live tables into the serving tables")
    command.add_argument("--root", required=True, help="folder of the live tables")
    command.add_argument("--database", default="analytics")
    command.add_argument("--buckets", type=int, default=jobs.RAW_BUCKETS)
    command.set_defaults(run=publish)

    command = commands.add_parser("deploy", help="start a new match session")
    command.add_argument("home")
    command.add_argument("away")
    command.add_argument("--warehouse", required=True)
    command.add_argument("--root", required=True, help="folder of the live tables")
    command.add_argument("--truncate", action="store_true", help="empty the team counts")
    command.set_defaults(run=deploy)

    command = commands.add_parser("reset", help="hide the live events of a session so far")
    command.add_argument("session")
    command.add_argument("--root", required=True)
    command.set_defaults(run=reset)

    command = commands.add_parser("stream", help="run the live streams")
    command.add_argument("--source", choices=("kafka", "files"), default="kafka")
    command.add_argument("--messages", required=True, help="servers, or a folder")
    command.add_argument("--root", required=True)
    command.add_argument("--every", help="trigger interval; without it, take what is there")
    command.add_argument("--version", default="v1", help="checkpoint version")
    command.add_argument("--buckets", type=int, default=jobs.RAW_BUCKETS, help="match buckets of the raw log")
    command.add_argument(
        "--unordered", action="store_true", help="split large message files; lines of a block tie"
    )
    command.add_argument("--warehouse", help="folder of the loaded history, for names and views")
    command.add_argument("--names", action="store_true", help="log the events with their names")
    command.add_argument("--views", action="store_true", help="keep the dashboard views current")
    command.add_argument("--state-partitions", type=int, help="fixed by the first run")
    command.set_defaults(run=stream)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    top = parser()
    options = top.parse_args(arguments)
    if options.command == "stream" and (options.names or options.views) and not options.warehouse:
        top.error("--names and --views need --warehouse")
    options.run(spark or build_session(), options)


if __name__ == "__main__":
    main()
