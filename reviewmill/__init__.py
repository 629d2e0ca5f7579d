"""Review text analytics as Spark jobs: profiling, text preparation, features, model comparison."""
