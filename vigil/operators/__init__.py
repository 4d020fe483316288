"""DataFrame operators: encoding, ranks and splits, neighbours and resampling,
metrics, history analytics, selectors and models."""
