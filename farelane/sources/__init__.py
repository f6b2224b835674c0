"""Scans: Parquet trip files, CSV dimensions, run-mode selection, manifests."""
