"""Table-level operators: cleaning, profiling, distributions, sampling, models and metrics."""
