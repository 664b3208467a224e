"""indexkit: weighted index scores on Spark DataFrames.

Sub-packages:

* ``functions``  – Column expressions (cleaning, exact ratios, hashing, bands).
* ``operators``  – DataFrame -> DataFrame operators (rollups, ranks, joins,
  profiles, agreement statistics, quality rules, scoring-run jobs).
* ``sources``    – landing of delimited text, run tables, sinks.
* ``streaming``  – incremental (load-once) ingestion and change detection.
* ``plans``      – the domain pipeline and the driver-table query registry.
"""

__version__ = "0.1.0"
