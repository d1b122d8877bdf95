"""Training-data operators: deduplication, token counts, filters, scans and archives.

Nothing else in the library imports this subpackage; it can be removed whole.
"""
