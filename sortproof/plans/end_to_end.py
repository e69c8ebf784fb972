"""The whole job: generate/land, sort by every key, verify (S1 -> K1 -> S2/P2 -> O9 -> K3 -> V5).

Each phase writes its result under ``out_dir`` (a folder every executor can
reach), so a lost executor costs at most a recomputation of the phase it was
in, and a rerun overwrites instead of appending a second copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sortproof.operators.parse import parse_strict
from sortproof.operators.sort import order_names, write_sorted_observed
from sortproof.operators.verify import verify
from sortproof.session import write_and_read
from sortproof.sinks.log import write_keyed_log
from sortproof.sources.generator import generate_records
from sortproof.sources.log import read_log

DEFAULT_KEYS = ("id", "name", "continent")


def run_end_to_end(
    spark: SparkSession,
    out_dir: str,
    n: int | None = None,
    source: DataFrame | None = None,
    keys=DEFAULT_KEYS,
    seed: int = 42,
    source_partitions: int = 4,
    num_ranges: int | None = None,
    exact: bool = False,
    fail: bool = False,
    java_string_order: bool = False,
) -> tuple[DataFrame, dict]:
    """Run the whole job; return the verification report and per-phase metrics.

    ``source`` (records) or ``n`` (generate that many) gives the input.  The
    source is written as a keyed log with ``source_partitions`` partitions,
    read back whole and parsed strictly once (landed), then sorted by every
    key; each sorted write reports its own row count and checksum (A6).
    """
    if source is None:
        if n is None:
            raise ValueError("give source records or a row count n")
        source = generate_records(spark, n, seed=seed)
    names = order_names(keys)
    out = out_dir.rstrip("/")
    write_keyed_log(source, "source", f"{out}/source", num_partitions=source_partitions)
    parsed = parse_strict(read_log(spark, f"{out}/source", topic="source"))
    landed = write_and_read(parsed, f"{out}/landed")
    outputs, metrics = {}, {}
    for name, k in zip(names, keys, strict=True):
        table, m = write_sorted_observed(landed, k, f"{out}/sorted/{name}", num_ranges,
                                         java_string_order=java_string_order, stable_input=True)
        outputs[name] = (table, k)
        metrics[name] = m
    # against the source log itself, so that a lossy landing cannot go unseen
    report = verify(parsed, outputs, exact=exact, fail=fail, java_string_order=java_string_order)
    return report, metrics
