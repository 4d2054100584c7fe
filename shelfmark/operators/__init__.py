"""DataFrame operators: deduplication, lookups, numbering, ranking, aggregation."""
