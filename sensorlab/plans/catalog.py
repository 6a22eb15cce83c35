"""Imports every catalog module so that all queries are registered."""

from sensorlab.plans import catalog_sql  # noqa: F401
from sensorlab.plans import catalog_profile  # noqa: F401
from sensorlab.plans import catalog_eval  # noqa: F401
from sensorlab.plans import catalog_sampling  # noqa: F401
from sensorlab.plans import catalog_models  # noqa: F401
from sensorlab.plans import catalog_io  # noqa: F401
from sensorlab.plans import catalog_tuning  # noqa: F401  (last: hours of fits)
