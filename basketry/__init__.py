"""basketry — retail customer analytics as PySpark DataFrame operators.

Every public operator is a pure function ``DataFrame -> DataFrame`` (or a
small family of them) built from Spark SQL expressions so Catalyst can push
filters into the scan, prune columns and keep the work inside whole-stage
codegen.  Sub-packages:

* ``functions``  – column expressions and the numeric rules (rounding, day
  differences, trimming, weekday numbering) shared by all operators.
* ``sources``    – readers / writers and the test-data mapping.
* ``operators``  – cleaning, profiling, features, segmentation, churn,
  metrics, lifetime summary and reporting operators.
* ``plans``      – the four batch jobs and the registry of named queries.
* ``streaming``  – incremental (append + keyed de-duplication) loads that
  also work as a Structured Streaming ``foreachBatch`` sink.
"""

__all__ = ["config"]
