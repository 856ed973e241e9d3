from plumbline.queries import (  # noqa: F401  (each module registers its queries)
    declared,
    drift,
    profiles,
    reports,
    rules,
    runs,
    scans,
    scores,
    snapshots,
)
from plumbline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
