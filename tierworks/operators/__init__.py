"""DataFrame -> DataFrame steps that the table plans are built from."""
