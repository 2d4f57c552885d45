"""Registered queries, by family."""

from . import events, joining, measures, selection, space, statistics, structure, terrain

MODULES = [selection, joining, statistics, structure, events, terrain, space, measures]
