"""DataFrame-to-DataFrame operators; chain them with `DataFrame.transform`."""
