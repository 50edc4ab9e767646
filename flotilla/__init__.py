"""flotilla: fleet mobility analytics on Spark.

Subpackages:

* ``sources``   -- positions (from the ``events`` table in tests), partitioned
  Parquet tables, JSON / legacy text, the versioned state store;
* ``functions`` -- column expressions (haversine);
* ``operators`` -- pairing, trips, snapshots, state fold, features, splits,
  histogram, models;
* ``plans``     -- the four workloads composed, the query registry, jobs;
* ``streaming`` -- the live state fold over arriving snapshot files.
"""

__version__ = "0.1.0"
