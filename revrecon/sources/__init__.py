"""Readers: raw exports in a landing folder -> typed tables."""
