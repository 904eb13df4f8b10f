"""Models (star schema), reports, the batch job and the query registry."""
