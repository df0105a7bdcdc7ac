"""Training-data operators: token counts, deduplication, sharding, quality,
mixing, fingerprints and token output, with their registered queries.

Nothing outside this subpackage imports it (``__spark_entry__`` adds its
queries only when it can be imported).
"""
