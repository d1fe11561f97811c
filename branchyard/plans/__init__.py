"""The load, check and publish workflow on the given tables, and the queries over it."""
