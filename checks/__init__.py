"""Registered queries with their SQL counterparts, over the supplied tables."""
