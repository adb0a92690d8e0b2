"""Registered queries, their SQL counterparts and the derived input tables."""
