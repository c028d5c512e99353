"""Training-data operators: scoring, filtering, mixing, tokenising and
de-duplicating text at corpus scale. Nothing outside this package imports it."""
