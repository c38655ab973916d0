"""claimflow: weak-labeled text-claim classification as Spark jobs.

Every public function takes and returns a DataFrame (or a small fitted
model object holding DataFrames) and is built from native column
expressions, joins, aggregations and windows so Catalyst can prune,
push down and plan the work.
"""

from claimflow.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
