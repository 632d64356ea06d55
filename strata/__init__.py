"""strata: panel analytics (entity x period x category measures) on Spark.

Operators take and return DataFrames and take column names as
arguments.  Sub-packages:

* ``sources``   - table loading, CSV with declared schemas, per-period
                  file panels, HTML extraction over a pages table
* ``functions`` - Column-returning helpers (slugs, folding, numbers)
* ``operators`` - reshape, winner, nearest-period join, statistics, ML
* ``plans``     - the query registry and its DuckDB oracle twins
* ``streaming`` - incremental ingest of per-period files
"""

from strata.session import checkpoint_dir, cut_lineage, local_session, scratch_path

__all__ = ["checkpoint_dir", "cut_lineage", "local_session", "scratch_path"]
