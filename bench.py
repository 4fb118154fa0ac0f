"""Time the headline queries; print one JSON line.

Reads ``$BENCH_SF_DIR`` (default the sf0.1 tables) on ``local[$BENCH_CPUS]``. Each
query or job runs once to warm up and then ``$BENCH_RUNS`` times; its figure is the
fastest run, from building the plan to the last row.
"""

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointstream.operators.decode import BUFFER, decode_frames, frame_rejects
from pointstream.operators.ledger import load_ledger
from pointstream.operators.lookup import enriched, lookup_join
from pointstream.operators.messages import (
    drop_sentinel,
    message_rejects,
    parse_messages,
    to_messages,
    to_readings,
)
from pointstream.plans import tables
from pointstream.plans.queries import QUERIES
from pointstream.sources.captures import read_captures
from pointstream.storage import shared_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "lookup_enrich",
    "lookup_enrich_unfiltered",
    "lookup_enrich_shuffled",
    "lookup_multi_match",
    "sentinel_filter",
    "count_enriched",
    "datagen_lookup",
    "ledger_window",
    "ledger_replay",
    "stream_enrich",
    "stream_count",
    "sink_replay",
    "sink_new_checkpoint",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("pointstream-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def drain(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def fastest(run) -> float:
    run()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def landed(spark: SparkSession) -> dict:
    """Jobs on frames, messages and responses landed beforehand, a file for each core."""
    events = tables.table(spark, SF_DIR, "events")
    records = tables.as_records(events, "event_id")
    made = {
        "frames": tables.as_frames(events),
        "cut": tables.cut_frames(events),
        "messages": to_messages(records, ["event_id"]),
        "spoiled": tables.spoiled_messages(to_messages(records, ["event_id"])),
        "responses": tables.as_responses(events),
    }
    found = {}
    for name, frame in made.items():
        path = shared_folder(spark, name)
        frame.repartition(int(CPUS)).write.parquet(path)
        found[name] = spark.read.schema(frame.schema).parquet(path)
    points = tables.point_dim(spark, SF_DIR)

    def look_up(readings: DataFrame) -> DataFrame:
        return enriched(lookup_join(drop_sentinel(readings), points))

    frames = found["frames"]
    return {
        "frame_decode": lambda: decode_frames(frames),
        "frame_decode_padded": lambda: decode_frames(frames, padding=BUFFER),
        "frame_rejects": lambda: frame_rejects(found["cut"]),
        "message_roundtrip": lambda: parse_messages(found["messages"]),
        "message_rejects": lambda: message_rejects(found["spoiled"]),
        "frames_to_enriched": lambda: look_up(parse_messages(to_messages(decode_frames(frames)))),
        "frames_to_enriched_fused": lambda: look_up(to_readings(decode_frames(frames))),
        "ledger_daily": lambda: load_ledger(found["responses"], F.col("run_date")),
    }


def captured_decode(spark: SparkSession) -> tuple[float, int]:
    """Decode of captured full frames in as many files as there are cores.

    Each event's frame is filled up to 76 or 78 records by repeating its body.
    """
    path = shared_folder(spark, "captured")
    frames = tables.as_frames(tables.table(spark, SF_DIR, "events"))
    held = "(length(payload) - 10) div 13"
    head, body = "hex(substring(payload, 1, 10))", "hex(substring(payload, 11))"
    full = f"unhex(concat({head}, repeat({body}, int(1014 div (length(payload) - 10)))))"
    filled = frames.filter(f"{held} BETWEEN 1 AND 4").withColumn("payload", F.expr(full))
    filled.repartition(int(CPUS)).write.parquet(path)
    captured = read_captures(spark, path)
    rows = decode_frames(captured).count()
    return fastest(lambda: drain(drop_sentinel(decode_frames(captured)))), rows


def main() -> None:
    spark = session()
    times = {}
    for name in HEADLINE:
        times[name] = fastest(lambda: drain(QUERIES[name](spark, SF_DIR)))
        print(name, times[name], file=sys.stderr, flush=True)
    for name, job in landed(spark).items():
        times[name] = fastest(lambda: drain(job()))
        print(name, times[name], file=sys.stderr, flush=True)
    times["decode_captured"], records = captured_decode(spark)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "decoded_records": records,
                "decoded_records_per_sec": round(records / times["decode_captured"]),
            }
        )
    )


if __name__ == "__main__":
    main()
