"""DataFrame -> DataFrame operators (kinship, dimensions, merges, closure)."""
