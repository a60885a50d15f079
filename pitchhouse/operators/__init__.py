"""Operators Spark has no single built-in for, composed from DataFrame ops:
size-checked broadcast, distributed surrogate keys, the team-grain unpivot
and the declarative data tests."""
