"""Send task code with the job, so executors need no installed copy of the package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_with_job(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
