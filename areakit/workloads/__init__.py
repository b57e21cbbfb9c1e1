"""The library's operators as named queries over the test tables."""

from areakit.workloads.batch import QUERIES as _BATCH
from areakit.workloads.landing import QUERIES as _LANDING
from areakit.workloads.modelling import QUERIES as _MODELLING
from areakit.workloads.oracle import ORACLE

QUERIES = {**_BATCH, **_LANDING, **_MODELLING}

__all__ = ["ORACLE", "QUERIES"]
