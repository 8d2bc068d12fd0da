"""Named tables, file ingestion and the test views."""
