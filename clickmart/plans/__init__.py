"""Named queries (the registry) and the hourly pipeline."""
