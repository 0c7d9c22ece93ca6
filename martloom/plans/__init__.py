"""Table definitions: silver, gold, semantic views, metrics, analytics."""
