"""Reading canonical inputs, bulk loading, and writing derived tables."""
