"""DataFrame -> DataFrame operators; chain them with df.transform(...)."""
