"""Writers and table maintenance: raw zone, lake tables, catalog, reports."""
