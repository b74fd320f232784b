"""Queries over the given tables, each with its SQL counterpart."""

from starweave.queries import checks, files, loads, stars, values

MODULES = (stars, values, checks, files, loads)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
