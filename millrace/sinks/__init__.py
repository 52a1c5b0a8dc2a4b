"""Writers and load jobs."""
