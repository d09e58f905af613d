"""Feed schemas, JSON-lines / zip ingest and feeds derived from the events table."""
