"""Training-data operators: deduplication, quality, packing, sharding,
mixing, tokens, fingerprints, archives and license scans.

Nothing else in the library imports this subpackage.  ``QUERIES`` and
``ORACLE`` hold the registered queries of its modules."""

from streamkit.llm.registry import ORACLE, QUERIES  # noqa: F401
from streamkit.llm import (archives, fingerprints, license_scan, mixing, near_dedup, packing,  # noqa: F401
                           quality_rules, sharding, substring_dedup, token_alignment, token_counts, token_files, whitening)
