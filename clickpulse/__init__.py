"""clickpulse: click-log and ad-click analytics on Spark DataFrames.

Every analysis is a pure function ``DataFrame(s) -> DataFrame`` built from
built-in Spark SQL expressions, so Catalyst/AQE plan the physical work.
Batch and streaming share these functions (see ``clickpulse.streaming``).
"""

from clickpulse.session import get_session, checkpoint_dir, pin_utc

__all__ = ["get_session", "checkpoint_dir", "pin_utc"]
