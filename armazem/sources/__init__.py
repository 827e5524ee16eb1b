"""Raw files, table sinks and the binding of the provided test tables."""
