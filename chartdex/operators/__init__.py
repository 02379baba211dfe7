"""DataFrame operators: filters, reshaping, lookups, aggregation, ordering and table maintenance."""
