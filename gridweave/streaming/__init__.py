"""Documents that keep arriving in a folder."""
