"""DataFrame → DataFrame operators: profile, clean, consolidate, aggregate."""
