"""Sources: driver test tables, the state-vector feed derived from them, and
JSON landing / Bronze readers and writers."""
