"""All queries of the library, by name, with their SQL twins."""

from __future__ import annotations

from strandline.plans import continent, fields, mosaics, sides, stacks, vectors

PARTS = (mosaics, stacks, vectors, continent, sides, fields)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in PARTS for name, sql in part.ORACLE_SQL.items()}
