"""lodestar: campaign-propensity analytics as plain Spark DataFrame operators.

Every public function takes DataFrames (plus explicit keys, columns and
dates) and returns a lazy DataFrame, so Catalyst sees one plan from the
parquet scan to the sink.  Sub-packages:

* ``functions``  column expressions (month arithmetic, calendar labels,
  recodes, safe arithmetic)
* ``sources``    reads, writes, checkpoints, exports, run log, and the
  adapters that shape the driver's test tables into the reference roles
* ``operators``  table-level operators (label, reduce, pivot, household
  mart, lags, impute, derive, sample, rank, evaluate, model)
* ``plans``      the end-to-end training / scoring / mart flows and the
  registered query set
* ``streaming``  the monthly mart as an incremental Structured Streaming job
"""

__version__ = "0.1.0"
