"""Views, measures, the batch job, and the named query registry with its SQL oracles."""
