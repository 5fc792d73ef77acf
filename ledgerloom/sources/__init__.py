"""Tables, JSON landing folders and report sinks."""
