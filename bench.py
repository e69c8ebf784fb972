"""Benchmark: the reference's job phases on the driver's tables.

Phases (each timed, rows/s derived from the record count):
  generate        S1 synthetic records (as many as lineitem rows) -> keyed log (K1)
  source_log      records view (joins) -> keyed 4-partition source log (K1)
  land            read the source log, parse every line strictly, write the
                  records once (S2 + P2)
  sort_id/name/continent
                  range-sort the landed records, write the positioned output
                  (O1/O2/O3 + K3)
  global_rank     exact 1-based rank of every row of the id output (O8)
  verify          counts, checksums and neighbour order of source + 3
                  outputs (V1-V3, V5); exact multiset difference (V4) too

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sortproof.operators.aggregate import count_and_checksum  # noqa: E402
from sortproof.operators.parse import parse_strict  # noqa: E402
from sortproof.operators.sort import global_rank, write_sorted  # noqa: E402
from sortproof.operators.verify import verify  # noqa: E402
from sortproof.session import get_spark, scratch_path, write_and_read  # noqa: E402
from sortproof.sinks.log import write_keyed_log  # noqa: E402
from sortproof.sources.generator import generate_records  # noqa: E402
from sortproof.sources.log import read_log  # noqa: E402
from sortproof.sources.tables import read_table, records_from_tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(
        master=f"local[{cpus}]",
        app_name="sortproof-bench",
        shuffle_partitions=4 * cpus,
        conf={"spark.driver.memory": "16g"},
    )
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # warm-up (JVM start, class loading, code generation); not timed
    warm = records_from_tables(spark, sf_dir).limit(1000)
    write_sorted(warm, "id", scratch_path(spark, "warm"))
    count_and_checksum(warm.repartition(cpus)).collect()

    # lineitem at sf0.1 is a single Parquet row group, i.e. one scan task;
    # the generator and the source log are spread over all cores the way a
    # producer with many tasks would write them.
    n_rows = read_table(spark, sf_dir, "lineitem").count()

    def generate():
        recs = generate_records(spark, n_rows, seed=42, num_partitions=4 * cpus)
        write_keyed_log(recs, "generated", scratch_path(spark, "gen"), 4)

    timed("generate", generate)

    src_path = scratch_path(spark, "source")
    timed("source_log", lambda: write_keyed_log(records_from_tables(spark, sf_dir).repartition(4 * cpus),
                                                "source", src_path, 4))
    source = parse_strict(read_log(spark, src_path, topic="source"))
    n = source.count()

    # landed once: a range sort reads its input twice (it samples first)
    landed = timed("land", lambda: write_and_read(source, scratch_path(spark, "landed")))
    outputs = {}
    for key in ("id", "name", "continent"):
        outputs[key] = timed(
            f"sort_{key}",
            lambda key=key: write_sorted(landed, key, scratch_path(spark, f"sorted-{key}")),
        )

    timed("global_rank", lambda: global_rank(outputs["id"]).agg(F.max("pos")).collect())

    report = timed("verify", lambda: verify(source, {k: (t, k) for k, t in outputs.items()}).collect())
    passed = [r for r in report if r["check"] == "all"][0]["passed"]
    timed("verify_exact", lambda: verify(source, {"id": (outputs["id"], "id")}, exact=True).collect())

    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "rows": n,
                "rows_per_sec": {k: round(n / v) for k, v in times.items() if v > 0},
                "cpus": cpus,
                "verified": bool(passed),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
