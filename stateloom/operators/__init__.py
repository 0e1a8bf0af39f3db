"""DataFrame-to-DataFrame operators shared by the table plans."""
