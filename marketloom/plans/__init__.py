"""Serving queries over the metric tables and over published alerts."""
