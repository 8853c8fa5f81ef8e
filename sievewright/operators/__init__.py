"""DataFrame operators: profile, filter, de-duplicate, convert."""
