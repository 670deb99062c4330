"""Landing files, their specifications and the layer store."""
