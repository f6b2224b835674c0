"""Incremental (file-stream) form of the monthly curation job."""
