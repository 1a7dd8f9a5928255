"""skyledger: a Spark-native warehouse for per-entity sensor readings.

Every operator maps DataFrames to DataFrames and stays lazy; only the sinks in
``sources.tables``, the gate in ``operators.gate`` and the stream in
``streaming`` run jobs.
"""

from .session import build_session, scratch_dir, use_utc

__all__ = ["build_session", "scratch_dir", "use_utc"]
