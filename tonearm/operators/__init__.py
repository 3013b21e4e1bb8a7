"""DataFrame-to-DataFrame operators. Column names are parameters where tables differ."""
