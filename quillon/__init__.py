"""Analytics on co-occurrence data, expressed as DataFrame, SQL and Arrow operations."""
