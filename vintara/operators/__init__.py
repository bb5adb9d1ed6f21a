"""DataFrame -> DataFrame operators of the vintage engine."""
