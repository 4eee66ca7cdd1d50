"""Imports every catalog module so that all queries are registered."""

from . import catalog_core  # noqa: F401
from . import catalog_sources  # noqa: F401
from . import catalog_model  # noqa: F401
