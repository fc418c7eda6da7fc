"""Report plans and the query registry."""
