"""Windows over streams of files."""
