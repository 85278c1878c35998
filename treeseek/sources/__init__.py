"""Where nodes, assets and stored indexes are read from."""
