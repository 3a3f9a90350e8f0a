"""tidemark: change-feed analytics on Spark.

Reads an append-only change log of many tables, resumes each table after its
saved ``(LSN, seq)`` cursor, decodes and orders changes, wraps them as JSON,
batches them by sampled message size, publishes, and keeps offsets
(at-least-once).  Subpackages: ``sources`` (readers, writer, fixtures),
``functions`` (column expressions), ``operators`` (cursor, ordering,
batching, offsets), ``plans`` (feed records, cycles, registered queries) and
``streaming`` (Structured Streaming feed).
"""

__version__ = "0.1.0"
