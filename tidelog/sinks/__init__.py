"""Writers for batch frames, and the keyed table that upserts go to."""
