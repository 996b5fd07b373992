"""The batch job, and the query registry over the supplied tables."""
