"""``spark-submit``-able jobs: ``python -m alluvia <job> [--option value ...]``."""

from __future__ import annotations

import argparse
import sys

from alluvia.config import LAYERS, LakeConfig
from alluvia.operators import nested
from alluvia.plans import bronze, demo, dimensions, ingest, maintenance, silver
from alluvia.plans.tables import MESSAGE_TABLES
from alluvia.session import build_session
from alluvia.sinks.messages import publish_messages, write_message_files
from alluvia.sources.streams import read_topic, stream_messages
from alluvia.streaming.lifecycle import StopOnSignal, watch

PROFILE = {"bronze": "bronze", "silver": "silver", "optimize": "bronze", "demo": "bronze", "process-events": "bronze"}


def named(text: str) -> tuple[str, str]:
    name, mark, value = text.partition("=")
    if not (name and mark):
        raise argparse.ArgumentTypeError(f"not NAME=VALUE: {text!r}")
    return name, value


def broker_options(servers: str, given: list[tuple[str, str]]) -> dict[str, str]:
    """The option map that reaches the Kafka reader."""
    return {"kafka.bootstrap.servers": servers, **dict(given)}


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="alluvia")
    jobs = ["ingest", "bronze", "silver", "static-to-csv", "load-dimensions", "register", "optimize", "demo", "process-events", "reports"]
    parser.add_argument("job", choices=jobs)
    parser.add_argument("--root", required=True, help="root URI of the lake")
    for layer in LAYERS:
        parser.add_argument(f"--{layer}-root", help=f"root URI of the {layer} layer, where it is not below the lake's")
    parser.add_argument("--brokers", help="Kafka bootstrap servers; without it messages come from files")
    parser.add_argument("--broker-option", action="append", default=[], metavar="NAME=VALUE", type=named,
                        help="option of the Kafka connector, such as kafka.security.protocol=SASL_SSL; repeatable")
    parser.add_argument("--messages", help="root of message directories, one per topic")
    parser.add_argument("--kinds", default="match,participant,unit")
    parser.add_argument("--in-turn", action="store_true", help="silver: one stream after the other")
    parser.add_argument("--document", help="static JSON document")
    parser.add_argument("--documents", help="ingest: match documents, one JSON text a line")
    parser.add_argument("--once", action="store_true", help="bronze, process-events: work off what is there and end")
    parser.add_argument("--folder", help="folder of the CSV files")
    given = parser.parse_args(arguments)

    spark = build_session(f"alluvia-{given.job}", PROFILE.get(given.job, "batch"))
    own_roots = {layer: getattr(given, f"{layer}_root") for layer in LAYERS}
    config = LakeConfig(given.root, {layer: root for layer, root in own_roots.items() if root})
    kinds = given.kinds.split(",")
    if given.job == "bronze":
        if given.brokers:
            broker = broker_options(given.brokers, given.broker_option)
            source = lambda topic: read_topic(spark, topic, broker)
        else:
            source = lambda topic: stream_messages(spark, f"{given.messages}/{topic}")
        bronze.run_bronze(spark, config, source, kinds, None if given.once else "30 seconds")
    elif given.job == "ingest":
        documents = nested.parse_match_documents(spark.read.text(given.documents), "value")
        for kind, messages in ingest.match_messages(documents).items():
            topic = MESSAGE_TABLES[kind].topic
            if given.brokers:
                publish_messages(messages, broker_options(given.brokers, given.broker_option), topic)
            else:
                write_message_files(messages, f"{given.messages}/{topic}")
    elif given.job == "silver":
        silver.run_silver(spark, config, kinds, together=not given.in_turn)
    elif given.job == "static-to-csv":
        dimensions.static_to_csv(spark, given.document, given.folder)
    elif given.job == "load-dimensions":
        outcome = dimensions.load_dimensions(spark, config, given.folder)
        print(outcome)
        return dimensions.exit_code(outcome)
    elif given.job == "register":
        print(bronze.register_bronze(spark, config) + silver.register_silver(spark, config))
    elif given.job == "optimize":
        outcome = maintenance.optimize_bronze(spark, config, kinds)
        print(outcome)
        return int(bool(outcome.failed))
    elif given.job == "reports":
        for layer, found in (("events", demo.event_reports), ("processed", demo.processed_reports)):
            table = {"events": demo.EVENTS, "processed": demo.PROCESSED}[layer]
            for name, report in found(spark.read.parquet(config.paths("bronze", table).data)).items():
                print(f"{layer}: {name}")
                report.show(truncate=False)
    else:
        if given.job == "demo":
            running = [demo.produce_events(spark, config)]
        else:
            running = demo.process_events(spark, config, None if given.once else "15 seconds", monitor=not given.once)
        with StopOnSignal(*running):
            watch(spark, running)
    return 0


if __name__ == "__main__":
    sys.exit(main())
