"""DataFrame-to-DataFrame operators and the model fits built on them."""
