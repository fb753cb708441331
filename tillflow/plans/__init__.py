"""Whole jobs: operators put together."""
