"""Training-data operators: token files, packing, archives, scans, deduplication, scoring.

Nothing else in the package imports this subpackage; its queries are in
:mod:`wardlens.llm.queries`.
"""
