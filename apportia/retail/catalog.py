"""All named queries; importing the modules registers them."""

from apportia.retail import (  # noqa: F401
    function_queries,
    history_queries,
    join_queries,
    load_queries,
    results_queries,
    scan_queries,
    sink_queries,
)
from apportia.retail.registry import ORACLE, QUERIES  # noqa: F401
