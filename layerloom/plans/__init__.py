"""Marts, metrics, reports and the end-to-end run."""
