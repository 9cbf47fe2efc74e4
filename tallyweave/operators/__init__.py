"""Table operators: mapping, alignment, resolution, quality, merge, load and incremental reads."""
