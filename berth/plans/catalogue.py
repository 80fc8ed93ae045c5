"""All registered queries; importing a module registers its queries."""

from berth.plans import (  # noqa: F401
    dictionary,
    file_profiles,
    files,
    history,
    mapping,
    parts,
    profiling,
    relations,
    runlog,
    rollups,
    runs,
    sensitive,
    streams,
    text,
)
from berth.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
