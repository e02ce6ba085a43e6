"""Named transformations: the music star schema, query tables, the travel lake and reports."""
