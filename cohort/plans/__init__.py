"""Plan shape: stage boundaries, the feature registry, whole flows."""
