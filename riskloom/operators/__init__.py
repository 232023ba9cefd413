"""DataFrame-to-DataFrame steps: features, store, analytics, evaluation, monitoring."""
