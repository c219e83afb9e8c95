"""DataFrame operators: normalizing, deduplicating, merging, lookups and quantiles."""
