"""Saved ETL jobs (:mod:`~cartwheel.plans.etl`), the rerun-safe table sink
(:mod:`~cartwheel.plans.sink`) and the job registry
(:mod:`~cartwheel.plans.registry`)."""
