"""Times pairs of plans for the same result: a job per column, tier or file pass, and ours.

No timings are published for the reference, so this stands in for a comparison:
Prints one JSON line. Same settings as bench.py.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ladderlake import stand_ins as views  # noqa: E402
from ladderlake.functions import encode_json, missing, win_rate  # noqa: E402
from ladderlake.operators import (  # noqa: E402
    describe,
    describe_by,
    match_facts,
    null_profile,
    number_rows,
)
from ladderlake.operators.ranking import standings_order  # noqa: E402
from ladderlake.schemas import match_schema  # noqa: E402
from ladderlake.session import build_session, staging_path  # noqa: E402
from ladderlake.sources import scan_json  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def pairs(spark, sf_dir):
    docs = views.match_docs(spark, sf_dir, views.landed_participant())
    landed = staging_path(spark, "shapes")
    body = docs.filter("info.participants is not null").select(encode_json("metadata", "info"))
    body.write.text(landed)
    fields = list(views.landed_participant())

    def facts(schema):
        return match_facts(scan_json(spark, landed, schema, "part-*"), fields)

    stored = staging_path(spark, "facts")
    with_tier = facts(match_schema(fields)).withColumn("tier", F.col("championName"))
    with_tier.write.partitionBy("tier").parquet(stored)
    gold = spark.read.parquet(stored)
    tiers = ("A-F", "A-O", "N-F", "N-O", "R-F", "R-O")

    standings = staging_path(spark, "standings")
    views.standings(spark, sf_dir).write.parquet(standings)
    players = spark.read.parquet(standings)

    def column_jobs():
        raw = facts(match_schema(fields))
        raw.count()
        for field in raw.schema:
            raw.filter(missing(field.name, field.dataType)).count()

    def tier_jobs():
        for tier in tiers:
            run(describe(gold.filter(F.col("tier") == tier), "totalDamageDealt"))

    def windowed_rank():
        rated = players.withColumn("win_percentage", win_rate("wins", "losses"))
        window = Window.partitionBy("tier").orderBy(*standings_order(views.COLS))
        run(rated.withColumn("rn", F.row_number().over(window)))

    def sliced_rank():
        rated = players.withColumn("win_percentage", win_rate("wins", "losses"))
        run(number_rows(rated, ["tier"], standings_order(views.COLS)))

    return {
        "scan of landed matches": (
            ("schema inferred", lambda: run(facts(None))),
            ("schema declared", lambda: run(facts(match_schema(fields)))),
        ),
        "null share of 9 columns": (
            ("a job per column", column_jobs),
            ("one pass", lambda: run(null_profile(facts(match_schema(fields))))),
        ),
        "description of 6 tiers": (
            ("a job per tier", tier_jobs),
            ("one pass", lambda: run(describe_by(gold, ["tier"], "totalDamageDealt"))),
        ),
        "full ranking": (("window", windowed_rank), ("range slices", sliced_rank)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "shapes",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    result = {}
    for name, shapes in pairs(spark, sf_dir).items():
        times = {label: [] for label, _ in shapes}
        for _ in range(4):  # the first round warms up
            for label, work in shapes:
                start = time.perf_counter()
                work()
                times[label].append(time.perf_counter() - start)
        result[name] = {label: round(min(t[1:]), 2) for label, t in times.items()}
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
