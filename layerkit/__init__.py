"""layerkit: layered (bronze / silver / gold) retail analytics on PySpark.

Everything is plain DataFrame / Structured Streaming code:

* ``sources``    - incremental JSON ingest with pinned types and a rescue column,
                   plus the mapping of the shared test tables to the retail shape.
* ``functions``  - column expressions: trimming, exact money rounding, validity rules,
                   and the three silver cleaners.
* ``operators``  - change-data-capture cores (SCD type 1 / type 2), the marts, and a
                   skew-safe per-key rank.
* ``sinks``      - append / versioned snapshot writers (range-clustered or key-bucketed),
                   table metadata.
* ``streaming``  - availableNow append flows and the incremental CDC apply.
* ``plans``      - the 11-dataset pipeline (layer waves, independent datasets concurrent),
                   the query registry and its SQL oracle.
"""

__version__ = "0.1.0"
