"""Queries by name, and SQL that gives the same rows where SQL can say it. They run the operators over the driver's tables, each over whole tables."""

from . import audits, learning, names, parcels, rasters, spatials, storage

QUERIES: dict = {}
ORACLES: dict = {}
for module in (parcels, names, rasters, spatials, audits, learning, storage):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES
