"""Event-time aggregates as Structured Streaming queries
(:mod:`~cartwheel.streaming.events`)."""
