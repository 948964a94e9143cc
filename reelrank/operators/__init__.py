"""DataFrame -> DataFrame operators: statistics, content similarity,
real-time scoring (batch form), latent factors and upserts."""
