"""Domain functions (calendar and planner, ingest, statements, factors,
prices) and the refresh actions over stored tables (``refresh``)."""
