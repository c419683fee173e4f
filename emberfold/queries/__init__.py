"""Queries over the driver tables, each with the SQL it must agree with."""

from emberfold.queries import (  # noqa: F401
    basics, hazards, learning, modelling, repairs, rollups, weather)
from emberfold.queries.base import ORACLES, QUERIES  # noqa: F401
