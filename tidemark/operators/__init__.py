"""DataFrame-to-DataFrame operators: lazy, no actions, no knowledge of storage."""
