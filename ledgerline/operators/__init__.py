"""Table operators: label sync, snapshot, restore, data-quality checks."""
