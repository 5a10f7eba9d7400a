"""Sources and sinks: declared schemas, CSV ingest, catalog, test adapter."""
