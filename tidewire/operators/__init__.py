"""DataFrame to DataFrame stages."""
