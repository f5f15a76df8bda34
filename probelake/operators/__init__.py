"""DataFrame operators of the lake."""
