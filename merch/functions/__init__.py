"""Column-level building blocks: text, numbers, lists and dates."""
