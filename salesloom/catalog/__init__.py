"""The registered queries: every inventory row bound to the star-schema test tables, with its SQL twin."""

from salesloom.catalog.registry import QUERIES, SQL  # noqa: F401
from salesloom.catalog import dashboards  # noqa: F401
from salesloom.catalog import analysis  # noqa: F401
from salesloom.catalog import streams  # noqa: F401
from salesloom.catalog import foundation  # noqa: F401
