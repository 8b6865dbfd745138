"""Driver queries over the generated test tables (correctness gate + bench)."""
