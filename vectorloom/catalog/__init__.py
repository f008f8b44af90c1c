"""All registered queries."""

from vectorloom.catalog import files, sequences, statistics, styles, tabular, training, vectors  # noqa: F401
from vectorloom.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
