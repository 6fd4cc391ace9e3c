"""Composed runs, the test-data adapters and the query registry."""
