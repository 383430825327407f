"""Mart outputs: partitioned Parquet, CSV, database tables."""

from derrick.sinks.writers import *  # noqa: F401,F403
