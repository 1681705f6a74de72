"""Named plans and their registry."""
