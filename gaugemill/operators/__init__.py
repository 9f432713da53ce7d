"""DataFrame operators; each is a pure function from relations to a relation."""
