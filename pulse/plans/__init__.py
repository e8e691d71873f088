"""Registered queries over the test tables, and the SQL each one must equal."""

from pulse.plans.oracle import ORACLE  # noqa: F401
from pulse.plans import stores  # noqa: F401
from pulse.plans.registry import QUERIES  # noqa: F401
