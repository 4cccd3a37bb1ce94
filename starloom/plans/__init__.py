"""Tables wired together, the query register and its checking SQL."""
