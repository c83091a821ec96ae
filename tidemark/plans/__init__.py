"""Plans: staging, dimensions, facts, aggregates, the build and the pipeline."""
