"""Every operator as a named query over the test tables, with its SQL twin.

``QUERIES`` maps a name to a builder ``(spark, folder) -> DataFrame``;
``ORACLES`` holds equivalent SQL for the names that SQL can express.
"""

from smeltery.catalogue.registry import ORACLES, QUERIES
from smeltery.catalogue import (  # noqa: F401  (imported to register their queries)
    aggregates,
    columns,
    rows,
    checks,
    records,
    releases,
    tables,
    time,
    training,
    whole,
)

__all__ = ["ORACLES", "QUERIES"]
