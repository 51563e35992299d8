"""DataFrame-to-DataFrame operators; all lazy unless they say otherwise."""
