"""The jobs as a user starts them, in a session of their own."""

import os
import subprocess
import sys
from datetime import datetime
from pathlib import Path

from alluvia.__main__ import broker_options, named
from alluvia.sources.streams import topic_options
from tests.test_rows import MATCH_BODIES, STATIC_BODY

ROOT = Path(__file__).resolve().parents[1]


def run(folder, *arguments):
    settings = os.environ | {"PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": "--master local[4] pyspark-shell"}
    done = subprocess.run(
        [sys.executable, "-m", "alluvia", *arguments], cwd=folder, env=settings, capture_output=True, text=True, timeout=300
    )
    return done.returncode, done.stdout


def test_broker_options_reach_the_reader():
    options = broker_options("b:1", [named("kafka.security.protocol=SASL_SSL"), named("startingOffsets=latest")])
    assert topic_options("t", options) == {
        "kafka.bootstrap.servers": "b:1", "kafka.security.protocol": "SASL_SSL", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }


def test_static_document_to_dimensions(here):
    with open(f"{here}/static.json", "w") as out:
        out.write(STATIC_BODY)
    lake = ["--root", f"{here}/lake", "--folder", f"{here}/csv"]
    assert run(here, "static-to-csv", "--document", f"{here}/static.json", *lake)[0] == 0
    code, text = run(here, "load-dimensions", *lake)
    assert code == 0 and text.count("SUCCESS") == 4
    assert run(here, "load-dimensions", "--root", f"{here}/lake", "--folder", f"{here}/missing")[0] == 1
    assert "skipped=['tft_matches'" in run(here, "optimize", *lake)[1]


def test_documents_to_silver(here):
    with open(f"{here}/documents.json", "w") as out:
        out.write("\n".join(body.replace("\n", " ") for body in MATCH_BODIES))
    lake = ["--root", f"{here}/lake", "--messages", f"{here}/messages"]
    assert run(here, "ingest", "--documents", f"{here}/documents.json", *lake)[0] == 0
    assert run(here, "bronze", "--once", *lake)[0] == 0
    assert run(here, "silver", "--in-turn", *lake)[0] == 0
    code, text = run(here, "register", *lake)
    assert code == 0 and all(name in text for name in ("bronze.tft_matches", "silver.tft_matches_scd2", "silver.tft_participant_units"))


def test_events_to_reports(spark, here):
    rows = [(i, f"User_{i}", "view", 100 * i, datetime(2024, 1, 7, 13)) for i in range(5)]
    spark.createDataFrame(rows, "id bigint, name string, event_type string, amount int, ingest_ts timestamp").write.parquet(
        f"{here}/lake/bronze/streaming_events")
    assert run(here, "process-events", "--once", "--root", f"{here}/lake")[0] == 0
    code, text = run(here, "reports", "--root", f"{here}/lake")
    assert code == 0 and "processed: by_tier" in text and "events: total" in text
