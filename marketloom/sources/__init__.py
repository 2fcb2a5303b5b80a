"""Tables and bus topics: reading, writing, registering."""
