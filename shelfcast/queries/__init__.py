"""Named queries: each operator on the retail tables of one star-schema directory."""

from shelfcast.queries import forecasts, joined, models, rollups, scalars, series, shapes, storage  # noqa: F401
from shelfcast.queries.common import REGISTRY  # noqa: F401
