"""Reading, decoding, checking and writing observations."""
