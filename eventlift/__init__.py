"""Product-event analytics as plain PySpark DataFrame functions.

Every public function takes DataFrames and returns a DataFrame, so the caller's
session, Catalyst and AQE decide the physical plan.  Sub-packages:

* ``sources``    message streams, event files, the partitioned raw lake
* ``operators``  validation, staging, facts, marts, sessions, scoring, serving
* ``streaming``  watermarked window aggregates, sinks, the fan-out job
* ``plans``      the mart dependency graph and the spark-submit entry points
* ``functions``  small column helpers and the exact distributed percentile
"""
