"""tastebud: recommender analytics as Spark DataFrame jobs.

Subpackages: ``sources`` (readers, sinks, driver-table mappings), ``functions``
(column expressions), ``operators`` (relational, encoding, splits, k-core, blocked
scoring, metrics, models), ``plans`` (registered queries with SQL oracles).
"""

from .session import cut_lineage, ensure_checkpoint_dir, local_session

__all__ = ["local_session", "ensure_checkpoint_dir", "cut_lineage"]
