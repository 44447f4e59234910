"""The warehouse layers: facts from changes, rollups from facts."""
