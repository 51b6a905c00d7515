"""All queries and oracles; importing the modules registers them."""

from starloom.plans import arrivals, footprints, inventory, lineage, photometry, pixels, scalars, selection, sky, sources  # noqa: F401
from starloom.plans.registry import ORACLES, QUERIES  # noqa: F401
