"""Physical-plan helpers: size bounds, salting, blocks, top-k, and the search plan."""
