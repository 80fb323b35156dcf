"""Concrete plans over the driver tables: role mapping, the star build, analytics, checks and the query catalog."""
