"""DataFrame operators: frames and column names in, a lazy frame out."""
