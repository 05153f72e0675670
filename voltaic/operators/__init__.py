"""DataFrame operators: aggregates, reshapes, ordered-series windows,
dedupe/upsert and quality checks.  Every operator is lazy, except the two
checkpointed variants (``quantiles.exact_quantiles`` and
``series.position_index(method="range")``), which run their range
partitioning and checkpoint when called."""
