"""All registered queries; importing the row modules fills the registry."""

from quakespark.registry import (  # noqa: F401
    comparison_rows,
    file_rows,
    geometry,
    loading_rows,
    pairing_rows,
    relocation_rows,
)
from quakespark.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
