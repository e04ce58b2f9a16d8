"""DataFrame-to-DataFrame operators; dimensions are passed in, never looked up."""
