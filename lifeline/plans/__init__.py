"""End-to-end plans of the two sync jobs, and the query registry."""
