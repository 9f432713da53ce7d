"""Jobs over stored tables, and the registry of runnable queries."""
