"""streamkit: event ingestion and table maintenance on Spark DataFrames.

Subpackages
-----------
sources    topic replay / Kafka scan, file scans and streams, data generators
functions  JSON decode/encode, schema resolution, alignment and evolution
operators  table maintenance (merge, delete, compaction, expiry), event-time
           windows, joins, de-duplication, quality checks and audits
streaming  sink specifications, triggers and query control
plans      the registered end-to-end queries and their SQL oracles
"""

__version__ = "0.1.0"
