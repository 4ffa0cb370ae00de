"""Layered (bronze / silver / gold) tables on plain PySpark."""
