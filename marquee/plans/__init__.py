"""End-to-end jobs (``jobs``), analyst reports (``reports``), the mapping of
the driver tables onto film-shaped inputs (``standins``) and the registered
queries with their DuckDB oracles (``catalog``)."""
