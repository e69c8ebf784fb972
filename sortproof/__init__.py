"""sortproof: produce and prove totally ordered datasets with Spark.

The reference's three jobs map to::

    generate  -> generate_records / records_for_rows, write_keyed_log
    sort      -> write_sorted (range sort + positions), rank_records, sort_many
    verify    -> verify (counts, checksums, order, optional exact difference)

and the whole job is :func:`run_end_to_end`.
"""

from sortproof.operators.parse import parse_quarantine, parse_strict, tag_lines
from sortproof.operators.sort import (
    global_rank,
    merge_sorted,
    rank_records,
    sort_many,
    sorted_chunks,
    total_sort,
    write_sorted,
)
from sortproof.operators.verify import multiset_difference, order_violations, verify
from sortproof.plans.end_to_end import run_end_to_end
from sortproof.sinks.log import write_keyed_log, write_single_partition_log, write_sorted_log
from sortproof.sources.generator import generate_records, records_for_rows
from sortproof.sources.log import read_lines, read_log, stream_log

__all__ = [
    "generate_records",
    "records_for_rows",
    "read_log",
    "stream_log",
    "read_lines",
    "parse_strict",
    "parse_quarantine",
    "tag_lines",
    "total_sort",
    "write_sorted",
    "global_rank",
    "rank_records",
    "sorted_chunks",
    "merge_sorted",
    "sort_many",
    "write_keyed_log",
    "write_single_partition_log",
    "write_sorted_log",
    "verify",
    "order_violations",
    "multiset_difference",
    "run_end_to_end",
]
