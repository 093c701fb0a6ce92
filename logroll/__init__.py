"""logroll: log ETL and reporting written as Spark DataFrame / SQL / Structured Streaming jobs.

Raw JSON log messages are classified into typed rows or dead-letter records, valid rows land in a
day-partitioned ``logs`` table and a one-minute rollup of mergeable states (counts, error counts,
latency sums, KLL sketches, exact latency frequencies), and trailing-window reports are answered
from the rollup.  Every public function takes and returns DataFrames or Columns; nothing is
collected to the driver.
"""

from logroll.session import get_session, configure, scratch_dir  # noqa: F401

__all__ = ["get_session", "configure", "scratch_dir"]
