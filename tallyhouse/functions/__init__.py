"""Column-level building blocks: schemas, text cleaning, label arithmetic, ratios."""
