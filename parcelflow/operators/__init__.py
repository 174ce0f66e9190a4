"""DataFrame-to-DataFrame steps; each works on a batch and on a stream."""
