"""Readers of channel drops and the raw landing."""
