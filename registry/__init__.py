"""Queries of the check contract, with their SQL counterparts."""
