"""General operators over DataFrames; none knows this domain's tables."""
