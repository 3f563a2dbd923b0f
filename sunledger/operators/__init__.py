"""DataFrame operators: envelope, registry, quality, transform, accounting."""
