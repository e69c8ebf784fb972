"""Make Python-side task code independent of the package being installed.

Functions that run inside Python workers (Arrow UDFs, state functions) are
pickled *by value* for the modules registered here, so executors need only
numpy/pandas/pyarrow, not this package on their ``PYTHONPATH``.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
