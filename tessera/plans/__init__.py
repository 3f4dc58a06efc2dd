"""The stages of the curation run, composed from operators, and the command line."""
