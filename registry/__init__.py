"""Checked queries: the operators wired to the test tables, with equivalent SQL."""
