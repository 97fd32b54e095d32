"""contrail: movement-track analytics expressed as Spark DataFrame plans.

Sub-packages:

* ``functions``  - Column -> Column helpers (typed extraction, rounding, time text).
* ``operators``  - DataFrame -> DataFrame operators (ordering, legs, places,
  geometry, ingest bookkeeping).
* ``sources``    - readers, writers and stand-in inputs built from the test tables.
* ``plans``      - the registered queries and their DuckDB oracle SQL.
* ``streaming``  - incremental (availableNow) ingestion of arriving day files.
"""

from contrail.session import checkpoint_dir, checkpoint_root, configure, get_session

__all__ = ["configure", "checkpoint_dir", "checkpoint_root", "get_session"]
