"""The steps end to end: ingest, curate, train, evaluate. Paths come from the caller."""
