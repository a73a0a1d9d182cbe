"""DataFrame operators of the mart."""
