"""Throughput at a larger size: the job phases on N generated records.

Usage: python tools/scale_probe.py [N] [cpus]   (default 6,000,000 on local[8])
Prints one JSON line with seconds and rows/s per phase.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sortproof.operators.aggregate import count_and_checksum  # noqa: E402
from sortproof.operators.parse import parse_strict  # noqa: E402
from sortproof.operators.sort import global_rank, write_sorted  # noqa: E402
from sortproof.operators.verify import verify  # noqa: E402
from sortproof.session import get_spark, scratch_path  # noqa: E402
from sortproof.sinks.log import write_keyed_log  # noqa: E402
from sortproof.sources.generator import generate_records  # noqa: E402
from sortproof.sources.log import read_log  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=8 * cpus, conf={"spark.driver.memory": "16g"})
    count_and_checksum(generate_records(spark, 10_000, num_partitions=cpus)).collect()  # warm-up
    times = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 2)
        return out

    src = scratch_path(spark, "scale-src")
    timed("generate", lambda: write_keyed_log(generate_records(spark, n, num_partitions=8 * cpus), "source", src, 4))
    source = parse_strict(read_log(spark, src, topic="source"))
    outs = {k: timed(f"sort_{k}", lambda k=k: write_sorted(source, k, scratch_path(spark, f"scale-{k}")))
            for k in ("id", "name", "continent")}
    timed("global_rank", lambda: global_rank(outs["id"]).agg(F.max("pos")).collect())
    rep = timed("verify", lambda: verify(source, {k: (t, k) for k, t in outs.items()}).collect())
    print(json.dumps({"rows": n, "cpus": cpus, "seconds": times,
                      "rows_per_sec": {k: round(n / v) for k, v in times.items()},
                      "verified": [r for r in rep if r["check"] == "all"][0]["passed"]}))


if __name__ == "__main__":
    main()
