"""Jobs: ingest, raw to trusted, trusted to delivery, and the whole chain."""
