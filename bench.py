"""Headline queries, timed. Prints one JSON line.

The tables the engine keeps (catalogue, tag index, search entries) are built first and timed as
``build_*``; the queries then run against them, as they would against written tables.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import registered
from checks.sessions import local_session
from tagweave.plans import star
from tagweave.session import tune

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")

BUILDS = {
    "build_raw": star.raw_catalogue,
    "build_items": star.items,
    "build_tag_index": star.index,
    "build_search_entries": star.entries,
    "build_gram_postings": star.postings,
    "build_gram_counts": star.posting_counts,
    "build_gram_heads": star.heads,
    "build_document_items": star.document_items,
    "build_document_index": star.document_index,
}


def main() -> None:
    spark = tune(local_session("bench"))
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name, build in BUILDS.items():
        start = time.perf_counter()
        build(spark, SF_DIR)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name, query in registered().items():
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of table builds and all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
