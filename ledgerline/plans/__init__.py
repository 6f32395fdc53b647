"""Plans: the layered warehouse, the pipeline run, business queries, the
query registry and the SQL oracle text."""
