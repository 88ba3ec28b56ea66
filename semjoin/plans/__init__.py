"""Fixture views, the query catalogue and its SQL oracles."""
