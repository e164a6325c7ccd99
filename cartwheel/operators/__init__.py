"""Relational operators over a :class:`cartwheel.sources.tables.Shop`:
star joins and pre-aggregates (:mod:`~cartwheel.operators.star`) and the
reports built on them (:mod:`~cartwheel.operators.reports`)."""
