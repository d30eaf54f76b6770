"""cartwheel: e-commerce clickstream analytics as Spark DataFrame operators.

Every public operator is a pure function ``DataFrame(s) -> DataFrame``: no
session creation, no actions for logging, nothing collected to the driver.
Thresholds, weights and durations are parameters whose defaults are the
values of the application this library re-implements.
"""

from cartwheel.schema import EVENT_SCHEMA, clickstream

__all__ = ["EVENT_SCHEMA", "clickstream"]
