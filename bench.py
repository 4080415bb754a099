"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the cores.
The tables are landed once, untimed, in several files each, as they would
arrive; pages are landed ``PAGE_COPIES`` times over, under new ids, so that HTML
jobs have work to do.  Each time covers building the plan and running it to the
last row and column; ``rows_per_sec`` counts the rows of the result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from inkloom.session import local_session, scratch_path
from inkloom.workload.registry import QUERIES

HEADLINES = """
    quarantine_payloads classify_fetches latest_per_url current_build_captures fetch_plan
    catalog_items book_summaries search_books book_people book_chapters chapter_details chapter_people
    select_chapters last_free_chapter assemble_book download_summary
    clean_html html_images html_text resolve_urls
    search_catalog_captures search_many_needles traverse_catalogs captures_by_build download_books
    write_library stream_dedupe stream_library
""".split()
TABLES = "events documents pages conversations orders lineitem part customer supplier nation".split()
PAGE_COPIES = 4


def landed(spark: SparkSession, sf_dir: str, files: int) -> str:
    """A copy of the tables in several files each."""
    folder = scratch_path(spark, "landed")
    for name in TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "pages":
            step = (rows.agg(F.max("page_id")).first()[0] or 0) + 1
            rows = rows.crossJoin(spark.range(PAGE_COPIES)).withColumn("page_id", F.col("page_id") + F.col("id") * step).drop("id")
        # streams tell the files of a table by their place, batch queries by the name
        rows.repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(str(cores), "bench")
    folder = landed(spark, sf_dir, cores)
    times, rates = {}, {}
    for name in sys.argv[1:] or HEADLINES:
        begun = time.perf_counter()
        seen = Observation()
        QUERIES[name](spark, folder).observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begun, 3)
        rates[name] = round(seen.get["rows"] / times[name])
    total = round(sum(times.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries", "value": total, "unit": "sec", "queries": times, "rows_per_sec": rates, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
