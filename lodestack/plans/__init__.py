"""Registered queries, one module for each family."""

from . import constraints, events, graphs, integrity, maps, pages, planner, posts, ranking, search, selection  # noqa: F401
