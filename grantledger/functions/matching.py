"""Join conditions over several columns of two aliased frames."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def same(columns: Iterable[str], left: str = "l", right: str = "r") -> Column:
    """All columns equal, NULL matching NULL."""
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def equal(columns: Iterable[str], left: str = "l", right: str = "r") -> Column:
    """All columns equal, NULL matching nothing."""
    return reduce(and_, [F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in columns])
