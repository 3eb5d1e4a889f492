"""Table contracts, scans, sinks and the panel built from the sales tables."""
