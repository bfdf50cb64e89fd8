"""marquee: catalogue analytics (nested movie documents) on Spark DataFrames.

Layers:
    sources/    read the normalised tables (driver parquet, headerless CSV) and
                write / read document tables (JSON lines, Parquet append)
    functions/  Column-level helpers: lenient and strict casts, NaN handling,
                array / map predicates and transforms
    operators/  DataFrame-level operators: denormalisation (nesting child
                rows into arrays and maps), lookups as semi joins, grouped
                aggregates (top row per group, trimmed mean, shares)
    plans/      the catalogue queries (Ru1-4, Rda1-4), reports, and the
                registry used by ``__spark_entry__``
    streaming/  incremental load of document files into a table
"""

__all__ = ["session"]
