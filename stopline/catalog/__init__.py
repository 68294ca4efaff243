"""All named queries; importing the package registers them."""

from stopline.catalog import ingestion, labelling, modelling, scalars  # noqa: F401
from stopline.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
