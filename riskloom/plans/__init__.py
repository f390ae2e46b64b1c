"""End-to-end flows: ingest, feature tables, training, promotion and monitoring."""
