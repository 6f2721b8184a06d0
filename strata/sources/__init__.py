"""Reading delimited sources and keeping track of their loads."""
