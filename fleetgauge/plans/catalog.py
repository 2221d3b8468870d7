"""All registered queries."""

from fleetgauge.plans import decisions, learning, monitoring, series  # noqa: F401
from fleetgauge.plans.registry import ORACLES, QUERIES  # noqa: F401
