"""DataFrame -> DataFrame operators: cleaning, measures, dimensions, keys,
facts and integrity checks."""
