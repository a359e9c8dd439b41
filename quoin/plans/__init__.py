"""Importing the package registers all queries."""

from . import files, registry, views  # noqa: F401
