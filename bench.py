"""Times the headline queries and prints one JSON line.

Folder and cores come from BENCH_SF_DIR and BENCH_CPUS. Each query runs once to
warm up and then once for its time, into a sink that discards the rows. Fitting
the models is timed by itself, on its only run.
"""

import json
import os
import time

from presscheck import session
from presscheck.plans import queries as Q

WARMED = (
    "clean_documents",
    "clean_pages",
    "accepted_documents",
    "rejected_conversations",
    "document_vocabulary",
    "tfidf_documents",
    "distinct_texts",
    "decide_documents",
    "report_cards",
    "page_articles",
    "aligned_documents",
    "forest_scores",
    "scorer_b_scores",
    "end_to_end",
    "stream_scores",
)


def run(spark, folder, name):
    started = time.monotonic()
    Q.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.monotonic() - started


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        session.builder("presscheck-bench")
        .master(f"local[{cores}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in WARMED:
        if name == "forest_scores":
            started = time.monotonic()
            Q.scorers(spark, folder)
            times["fit_scorers"] = time.monotonic() - started
        run(spark, folder, name)
        times[name] = run(spark, folder, name)
    session.remove_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
