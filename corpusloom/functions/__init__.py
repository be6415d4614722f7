"""Column functions; ``register`` makes them callable from SQL."""
