"""Registered end-to-end queries over the driver tables, each with the
ANSI SQL that computes the same result on DuckDB (when one exists).

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
"""

from streamkit.plans.registry import ORACLE, QUERIES  # noqa: F401
from streamkit.plans import checks, event_time, generated, ingest, joins, maintenance  # noqa: F401,E402
