"""pluvio: daily weather-station analytics as Spark DataFrame operators.

Layout
------
- ``schemas``     table contracts (StructTypes) shared by every layer
- ``session``     session builder and the shared work folder
- ``functions``   column expressions (keys, seasons, calendar truncation)
- ``operators``   DataFrame-in / DataFrame-out transforms (periods,
                  observations, stations, joins, aggregates, conformance)
- ``sources``     scans of landed JSON, page envelopes, snapshots, tables
- ``sinks``       landing, snapshots, manifest, keyed upserts, overwrites
- ``plans``       the presentation views and the composite jobs
- ``streaming``   incremental loading of newly landed days
- ``fixtures``    bridge views over the TPC-H-style test tables
"""

__version__ = "0.1.0"
