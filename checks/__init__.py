"""Registered queries on the shared test tables, with their SQL counterparts."""
