"""Readers: raw files, the external source of truth, catalog tables, file
inventories, and the fixture views derived from the test tables."""
