"""DataFrame operators: filters, lookups, deduplication, totals, layouts, run state."""
