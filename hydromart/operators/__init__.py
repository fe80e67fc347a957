"""DataFrame operators (each a plain function over DataFrames)."""
