"""DataFrame operators: cleaning, parsing, merging, resolving, checking, time series."""
