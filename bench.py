"""Wall time of the headline queries: one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

from tether.session import local_session
from workload.queries import REGISTRY

HEADLINE = ("link_entities", "mentions", "candidate_search", "similar_words", "dictionary_labels", "kb_abstracts", "document_mentions")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    # One small run starts the JVM's compiled code; it is not counted.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    REGISTRY["link_entities"](spark, small if os.path.isdir(small) else sf_dir).count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "entity linking, sum of query times", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
