"""Registered queries (Spark) and their oracle SQL, plus the layered run."""
