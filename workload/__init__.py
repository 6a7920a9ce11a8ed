"""Rail-shaped views over the TPC-H-like test tables, and the registered queries with their oracle SQL."""
