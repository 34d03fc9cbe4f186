"""Reading and writing: event streams, dimensions, fact tables and outgoing events."""
