"""Bindings of raw data to the customers / products / orders frames:
:mod:`~cartwheel.sources.tables` (parquet and catalog bindings),
:mod:`~cartwheel.sources.catalog` (namespaces, typed raw tables, literal rows),
:mod:`~cartwheel.sources.schemas` (declared schemas)."""
