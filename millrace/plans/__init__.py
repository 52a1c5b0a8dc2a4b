"""Named models of the commerce and rail domains, and their bindings to the test tables."""
