"""Registered queries: what the library computes over the test tables, with equivalent SQL."""
