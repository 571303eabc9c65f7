"""End-to-end plans: the gold build, the daily pipeline and the query registry."""
