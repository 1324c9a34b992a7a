"""All registered queries."""

from prepframe.plans import analysis, cleaning, exact, learning, reading  # noqa: F401
from prepframe.plans.registry import ORACLES, QUERIES  # noqa: F401
