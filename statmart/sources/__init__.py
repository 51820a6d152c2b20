"""Readers: delimited extracts, worksheets as cells, resource catalogs, tables, documents."""
