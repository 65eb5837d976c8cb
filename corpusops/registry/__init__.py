"""All registered queries, each over the whole tables of a folder."""

from . import boilerplate, features, files, labels, pages, tables, text  # noqa: F401  (registration)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
