"""DataFrame → DataFrame operators: cleaning, aggregation, quality and staging."""
