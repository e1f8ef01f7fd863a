"""File scans, sinks and the shared scratch area."""
