"""Query catalog: importing the query modules fills the registry.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL with
the same output columns) for every operator of the inventory that SQL can check.
"""

from __future__ import annotations

from eventfeat.plans import q_core  # noqa: F401
from eventfeat.plans.q_core import purchase_view_asof  # noqa: F401
from eventfeat.plans.registry import ORACLE, QUERIES  # noqa: F401

for _mod in ("q_parse", "q_stats", "q_split", "q_model", "q_io"):
    try:
        __import__(f"eventfeat.plans.{_mod}")
    except ModuleNotFoundError as e:  # modules land one by one
        if e.name != f"eventfeat.plans.{_mod}":
            raise
