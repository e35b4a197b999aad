"""DataFrame -> DataFrame operators of the two sync jobs."""
