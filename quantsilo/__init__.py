"""quantsilo: market and event-stream analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (or a small composition of
them).  Nothing in the library collects data to the driver; Catalyst plans,
shuffles and executes all work.  See README.md for the operator map.
"""

from quantsilo.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
