"""DataFrame-to-DataFrame operators of the analytics engine."""
