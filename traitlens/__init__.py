"""Spark-native product trait extraction and product-local similarity scoring."""

from __future__ import annotations

import sys

# Functions of this package that run inside Python workers (model jobs,
# plugged-in factories) are shipped by value, so executors do not need the
# package installed or on their path.
try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

__all__ = ["constants", "schemas", "session"]
