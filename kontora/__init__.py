"""Kontora: contact-list analytics on Spark."""
