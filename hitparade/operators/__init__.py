"""DataFrame → DataFrame operators: ingest, staging, star builders, quality."""
