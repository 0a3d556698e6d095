"""DataFrame operators: profiling, classification, catalogue, policy, generation."""
