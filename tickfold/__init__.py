"""tickfold: per-sensor run averages over wide, time-keyed tables, on Spark.

The work is expressed as DataFrame -> DataFrame operators:

* ``tickfold.sources``    key filters, pages, relational scans
* ``tickfold.functions``  scalar column expressions
* ``tickfold.operators``  unpivot, page numbering, runs, gates, sink shape
* ``tickfold.plans``      the backlog in one pass, and the incremental loop
* ``tickfold.streaming``  the count window over an unbounded stream
"""

__version__ = "0.1.0"
