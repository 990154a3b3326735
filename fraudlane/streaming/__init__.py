"""File-drop ingestion as a Structured Streaming query."""
