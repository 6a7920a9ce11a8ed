"""Readers over landed files, source catalogue, and the two table zones."""
