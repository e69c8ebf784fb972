"""Print the formatted physical plans of the main operators (sf0.01).

Usage: python tools/show_plans.py > docs/PLANS.md
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sortproof.operators.aggregate import dataset_stats  # noqa: E402
from sortproof.operators.parse import parse_strict  # noqa: E402
from sortproof.operators.sort import global_rank, sorted_chunks, total_sort, with_positions, write_sorted  # noqa: E402
from sortproof.operators.verify import chunk_check, multiset_difference, order_chunks, order_violations  # noqa: E402
from sortproof.session import get_spark, scratch_path  # noqa: E402
from sortproof.sinks.log import write_keyed_log  # noqa: E402
from sortproof.sources.log import read_log  # noqa: E402
from sortproof.sources.tables import records_from_tables  # noqa: E402

SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    text = re.sub(r"file:[^\]\s,]+", "<scratch>", text)
    # keep the tree and the scan/exchange details only
    keep, out = False, []
    for line in text.splitlines():
        if line.startswith("== Physical Plan =="):
            keep = True
        if re.match(r"^\(\d+\) (Scan parquet|Exchange|BroadcastExchange|Window|HashAggregate)", line):
            keep = True
        elif re.match(r"^\(\d+\) ", line):
            keep = False
        if keep:
            out.append(line)
    return "\n".join(out)


def main() -> None:
    spark = get_spark(master="local[8]", shuffle_partitions=16)
    recs = records_from_tables(spark, SF)
    log_path = scratch_path(spark, "log")
    write_keyed_log(recs, "source", log_path, 4)
    src = parse_strict(read_log(spark, log_path, topic="source"))
    sorted_t = write_sorted(src, "name", scratch_path(spark, "s"))
    sections = [
        ("Strict parse of a topic: filter pushed, two columns read", src),
        ("Total sort by name with positions (the written table)", with_positions(total_sort(src, "name"))),
        ("Global rank: single-partition window only over per-range counts", global_rank(sorted_t)),
        ("Order check of the verifier: one scan of key + position, one shuffle, a row per chunk",
         order_chunks(sorted_t, "name")),
        ("List of all violations: edges over the table of chunks, rows of chunks with violations",
         order_violations(sorted_t, "name", with_lines=False)),
        ("Chunk check: one window per written file, aggregated in place",
         chunk_check(sorted_t.withColumnRenamed("range_id", "chunk").withColumnRenamed("offset", "row_index"), "name")),
        ("Sorted chunks: no exchange", sorted_chunks(src, "name", 1 << 20)),
        ("Counts and checksums of two datasets in one aggregation", dataset_stats(
            {"source": src, "name": sorted_t.select("id", "name", "address", "continent")})),
        ("Exact multiset difference with partial aggregation", multiset_difference(
            src, sorted_t.select("id", "name", "address", "continent"))),
        ("Records view joins (fixture)", recs.select("id", "continent")),
    ]
    print("# Physical plans of the main operators\n")
    print(f"Generated by `tools/show_plans.py` on {SF} (local[8], 16 shuffle partitions, AQE on).")
    print("Initial plans; AQE re-plans joins and coalesces partitions at run time.\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{plan_text(df)}\n```\n")


if __name__ == "__main__":
    main()
