"""Multi-step pipelines."""
