"""DataFrame-to-DataFrame operators. Everything here is lazy unless its name starts with ``assert``."""
