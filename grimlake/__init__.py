"""grimlake: a Spark-native analytics warehouse for a music catalogue.

Library functions take DataFrames and return DataFrames; paths only appear in
``grimlake.sources``. Layout:

* ``sources``   - raw schemas, CSV/Parquet scans, sinks, driver-table adapter
* ``functions`` - Column helpers and the fixed rule tables
* ``operators`` - reusable distributed operators (ranks, group stats, checks)
* ``plans``     - the models: staging, period parsing, dims, fact, marts, jobs
* ``streaming`` - intentionally empty (the catalogue is batch full-refresh)
"""

from grimlake.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
