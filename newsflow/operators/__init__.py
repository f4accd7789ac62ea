"""DataFrame in, DataFrame out: filters, joins, aggregates and page-derived tables."""
