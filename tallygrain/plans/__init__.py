"""Named queries on the test tables, each with an independent SQL formulation where one exists."""
