"""Raw export schemas, typed CSV ingest, star-table sinks, and the test-input bindings."""
