"""Query plans bound to the test tables.  Importing this package registers them."""

from flowframe.plans import flows, groups, io, metrics, streams, tables, transforms, url_flow  # noqa: F401
from flowframe.plans.registry import ORACLE, QUERIES  # noqa: F401
