"""All registered queries of the library and their SQL."""

from . import queries

QUERIES, ORACLES = queries.QUERIES, queries.ORACLES
