"""eventfeat: Spark-native operators that turn event tables into leakage-safe feature tables.

Every public operator is a pure function ``DataFrame -> DataFrame`` (or returns a
small fitted object whose ``apply`` is again a DataFrame transform).  Work is
expressed with the DataFrame API so Catalyst can push filters, prune columns and
plan joins; Python only runs on the driver to build plans.
"""

from eventfeat.session import build_session, checkpoint_dir, ensure_checkpoint_dir

__all__ = ["build_session", "checkpoint_dir", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
