"""Table builders, data-quality rules, profiles and the batch job."""
